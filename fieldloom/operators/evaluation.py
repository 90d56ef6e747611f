"""Detection and tracking metrics, regression factors, histograms and grouped cross-validation."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..shared import written
from .grouped import fold_groups, numbers, ranked


def pr_grid(scored: DataFrame, thresholds: list[float]) -> DataFrame:
    """Precision, recall and F1 at each threshold from (label 0/1, score).

    Rows are first summed by the number of thresholds they pass, so that one row for each step, and not rows times thresholds, is shuffled.
    """
    spark = scored.sparkSession
    grid = spark.createDataFrame([(k, float(t)) for k, t in enumerate(sorted(thresholds))], "step int, threshold double")
    passed = sum((F.when(F.col("score") >= t, 1).otherwise(0) for t in thresholds), F.lit(0))
    binned = scored.groupBy(passed.alias("passed")).agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"))
    totals = binned.agg(F.sum("pos").alias("all_pos"))
    sums = grid.join(F.broadcast(binned), F.col("passed") > F.col("step"), "left").groupBy("threshold").agg(F.coalesce(F.sum("pos"), F.lit(0)).alias("tp"), F.coalesce(F.sum("neg"), F.lit(0)).alias("fp"))
    out = sums.join(F.broadcast(totals)).withColumn("fn", F.col("all_pos") - F.col("tp"))
    precision, recall = F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))
    out = out.withColumn("precision", precision).withColumn("recall", recall)
    return out.withColumn("f1", F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))).drop("all_pos")


def mean_absolute_percentage_error(rows: DataFrame, by: list[str], true: str, predicted: str) -> DataFrame:
    """Per cent; rows whose true value is 0 do not count."""
    return rows.groupBy(*by).agg((100 * F.avg(F.try_divide(F.abs(F.col(true) - F.col(predicted)), F.abs(F.col(true))))).alias("mape"))


def factor(rows: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """Least squares through the origin: y = factor * x."""
    return rows.groupBy(*by).agg(F.try_divide(F.sum(F.col(x) * F.col(y)), F.sum(F.col(x) * F.col(x))).alias("factor"))


def line(rows: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """Least squares with an intercept."""
    return rows.groupBy(*by).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def leave_one_group_out(rows: DataFrame, group: str, x: str, y: str) -> DataFrame:
    """For each group, the factor of all others and its relative error on the group's totals: total sums less the group's own."""
    sums = rows.groupBy(group).agg(F.sum(F.col(x) * F.col(y)).alias("xy"), F.sum(F.col(x) * F.col(x)).alias("xx"), F.sum(x).alias("sx"), F.sum(y).alias("sy"))
    whole = sums.agg(F.sum("xy").alias("all_xy"), F.sum("xx").alias("all_xx"))
    out = sums.join(F.broadcast(whole)).withColumn("factor", F.try_divide(F.col("all_xy") - F.col("xy"), F.col("all_xx") - F.col("xx")))
    return out.select(group, "factor", F.try_divide(F.col("factor") * F.col("sx") - F.col("sy"), F.col("sy")).alias("error"))


def histogram(rows: DataFrame, by: list[str], value: str, low: float, high: float, bins: int) -> DataFrame:
    """Counts by bin, of values in [low, high); the first bin is 0."""
    place = F.floor((F.col(value) - low) * bins / (high - low)).cast("int")
    return rows.where((F.col(value) >= low) & (F.col(value) < high)).groupBy(*by, place.alias("bin")).agg(F.count("*").alias("n"))


def mode_bin(hist: DataFrame, by: list[str]) -> DataFrame:
    """The fullest bin, the lowest of equals."""
    return hist.groupBy(*by).agg(F.max_by("bin", F.struct("n", -F.col("bin"))).alias("mode"))


def weighted_moments(hist: DataFrame, by: list[str]) -> DataFrame:
    mean = F.sum(F.col("bin") * F.col("n")) / F.sum("n")
    return hist.groupBy(*by).agg(mean.alias("mean"), F.sqrt(F.sum(F.col("bin") * F.col("bin") * F.col("n")) / F.sum("n") - mean * mean).alias("std"))


def saturated(values: DataFrame, by: list[str], value: str, share: float, limit: float) -> DataFrame:
    """Whether the given quantile of a frame's values is over a limit."""
    return values.groupBy(*by).agg((F.percentile(value, share) > limit).alias("saturated"))


def shift_noise(rows: DataFrame, by: list[str], order: str, value: str, low: float = -50, high: float = 200, size: int = 10) -> DataFrame:
    """Spread of a shift and its mean and median distance from a centred average of the clipped values, zero beyond the ends."""
    clipped = F.least(F.greatest(F.col(value), F.lit(low)), F.lit(high)).cast("double")
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(-(size // 2), size - size // 2 - 1)
    rows = rows.withColumn("__v", clipped)
    rows = rows.withColumn("__d", F.abs(F.col("__v") - F.sum("__v").over(w) / size))
    return rows.groupBy(*by).agg(F.stddev_pop("__v").alias("std"), F.avg("__d").alias("mean_gap"), F.percentile("__d", 0.5).alias("median_gap"))


def meter(rows: DataFrame, by: list[str], order: str, value: str, size: int) -> DataFrame:
    """Average over the last `size` values, and over all so far."""
    w = Window.partitionBy(*by).orderBy(order)
    return rows.select(*by, order, F.avg(value).over(w.rowsBetween(-(size - 1), 0)).alias("recent"), F.avg(value).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("overall"))


def mot_summary(pairs: DataFrame, by: list[str], least_iou: float, overall: bool = False) -> DataFrame:
    """CLEAR-MOT counts per scan from (by, frame, gt_id, trk_id, iou): a match of the frame before is kept while it holds, of the rest as many as can be are paired, with
    the greatest total overlap.

    Rows with a null trk_id or gt_id name unpaired true or found boxes of a frame. Matches, misses, false positives, switches, mota, precision, recall; with
    `overall`, a row more whose `by` is null has the same of the summed counts. Pairs are shuffled once, by scan, and a call takes many scans.
    """
    from .scoring import most_pairs

    kinds = dict(pairs.dtypes)

    def fold(table: pa.Table, groups: np.ndarray) -> pa.Table:
        frame, gt, trk = (ranked(table, c) for c in ("frame", "gt_id", "trk_id"))
        frame = np.where(frame < 0, frame.max() + 1, frame)  # a null comes last
        heads = np.searchsorted(groups, np.arange(groups[-1] + 1))
        n_true, n_found = (np.bincount(np.unique(np.stack([groups, frame, c], axis=1)[c >= 0], axis=0)[:, 0], minlength=len(heads)) for c in (gt, trk))
        iou = numbers(table, "iou")
        good = np.flatnonzero((gt >= 0) & (trk >= 0) & (iou >= least_iou))
        good = good[np.lexsort((frame[good], groups[good]))]
        ends = np.flatnonzero((np.diff(groups[good]) != 0) | (np.diff(frame[good]) != 0)) + 1
        pairs_of = list(zip(gt[good].tolist(), trk[good].tolist(), iou[good].tolist()))
        hits, switches, before, last = np.zeros(len(heads), np.int64), np.zeros(len(heads), np.int64), -1, {}
        for a, b in zip([0, *ends.tolist()], [*ends.tolist(), len(good)]):
            if a == b:
                continue
            scan = int(groups[good[a]])
            if scan != before:
                before, last = scan, {}
            options: dict = {}
            for g, t, v in pairs_of[a:b]:
                options[g, t] = max(v, options.get((g, t), 0.0))
            taken = {g: t for g, t in options if last.get(g) == t}
            gone = set(taken.values())
            taken |= most_pairs({(g, t): v for (g, t), v in options.items() if g not in taken and t not in gone})
            switches[scan] += sum(g in last and last[g] != t for g, t in taken.items())
            hits[scan] += len(taken)
            last |= taken
        out = table.select(by).take(pa.array(heads))
        for name, figure in (("matches", hits), ("misses", n_true - hits), ("false_positives", n_found - hits), ("switches", switches)):
            out = out.append_column(name, pa.array(figure.astype(np.int64)))
        return out

    counts = fold_groups(pairs.select(*by, "frame", "gt_id", "trk_id", "iou"), by, fold, ", ".join(f"{c} {kinds[c]}" for c in by) + ", matches long, misses long, false_positives long, switches long")
    if overall:
        counts = written(counts, "counts")  # the folds run once
        sums = counts.agg(*(F.sum(c).alias(c) for c in ("matches", "misses", "false_positives", "switches"))).where("matches is not null")
        counts = counts.unionByName(sums.select(*(F.lit(None).cast(kinds[c]).alias(c) for c in by), "*"))
    whole, wrong = F.col("matches") + F.col("misses"), F.col("misses") + F.col("false_positives") + F.col("switches")
    share = lambda n: F.try_divide(F.col("matches"), n)
    return counts.select("*", (1 - F.try_divide(wrong, whole)).alias("mota"), share(F.col("matches") + F.col("false_positives")).alias("precision"), share(whole).alias("recall"))


def error_figures(rows: DataFrame, by: list[str], true: str, predicted: str) -> DataFrame:
    """Mean and deviation (of the population) of the signed relative error; rows whose true value is 0 do not count."""
    error = F.try_divide(F.col(true) - F.col(predicted), F.col(true))
    return rows.groupBy(*by).agg(F.avg(error).alias("mean_error"), F.stddev_pop(error).alias("std_error"))


def naive_error(rows: DataFrame, kind: str, true: str) -> DataFrame:
    """The mean absolute relative error of predicting each kind's mean for all its rows."""
    mean = rows.groupBy(kind).agg(F.avg(true).alias("__mean"))
    error = F.try_divide(F.abs(F.col(true) - F.col("__mean")), F.col(true))
    return rows.join(mean, kind).agg(F.avg(error).alias("naive_error"))


def saturated_batches(values: DataFrame, batch: list[str], frame: str, value: str, share: float, limit: float) -> DataFrame:
    """Whether all frames of a batch are saturated."""
    return saturated(values, [*batch, frame], value, share, limit).groupBy(*batch).agg(F.every("saturated").alias("saturated"))


def median_meter(rows: DataFrame, by: list[str], order: str, value: str, size: int) -> DataFrame:
    """Median of the last `size` values."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(-(size - 1), 0)
    return rows.select(*by, order, F.percentile(value, 0.5).over(w).alias("median"))


def valid_figures(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """Mean and median of the values that are neither null nor NaN."""
    known = F.when(~F.isnan(value), F.col(value))
    return rows.groupBy(*by).agg(F.avg(known).alias("mean"), F.percentile(known, 0.5).alias("median"), F.count(known).alias("n"))


def cell_average(cells: DataFrame, by: list[str], value: str) -> DataFrame:
    """Mean of the cells that hold a figure; -1 marks those without."""
    return cells.groupBy(*by).agg(F.coalesce(F.avg(F.when(F.col(value) > -1, F.col(value))), F.lit(-1.0)).alias(value))


def regression(rows: DataFrame, by: list[str], xs: list[str], y: str, intercept: bool = True, log_target: bool = False) -> DataFrame:
    """(by, coefficients) of least squares on several columns, the intercept first; `log_target` fits log(1 + y), of which exp(x) - 1 predicts.

    Sums of products are aggregated where the rows are; the equations, of as many unknowns as there are columns, are solved in Python.
    """
    terms = ([F.lit(1.0)] if intercept else []) + [F.col(x).cast("double") for x in xs]
    target = F.log1p(F.col(y).cast("double")) if log_target else F.col(y).cast("double")
    n = len(terms)
    sums = rows.groupBy(*by).agg(F.array(*(F.sum(terms[i] * terms[j]) for i in range(n) for j in range(n))).alias("xx"), F.array(*(F.sum(t * target) for t in terms)).alias("xy"))

    def solve(parts):
        for pdf in parts:
            out = [np.linalg.lstsq(np.reshape(xx, (n, n)), np.asarray(xy), rcond=None)[0].tolist() for xx, xy in zip(pdf["xx"], pdf["xy"])]
            yield pdf[by].assign(coefficients=out)

    kinds = dict(rows.dtypes)
    return sums.mapInPandas(solve, ", ".join(f"{c} {kinds[c]}" for c in by) + ", coefficients array<double>")


def box_pr_grid(truth: DataFrame, found: DataFrame, by: list[str], confs: list[float], ious: list[float]) -> DataFrame:
    """(conf, iou, precision, recall, f1): means over the images that have boxes on both sides.

    True positives are the pairs with a score and an overlap above the thresholds, so that they may outnumber the boxes. Pairs meet by
    cells; pairs and boxes are first summed by the number of thresholds that they pass, and only those counts meet the grid.
    """
    from .geometry import cross_pairs, iou

    spark = truth.sparkSession
    passed = lambda c, limits: sum((F.when(c > t, 1).otherwise(0) for t in limits), F.lit(0))
    pairs = cross_pairs(truth, found, by).select(*by, passed(F.col("b.score"), confs).alias("cs"), passed(iou("a", "b", False, False), ious).alias("os")).groupBy(*by, "cs", "os").agg(F.count("*").alias("n"))
    predicted = found.groupBy(*by, passed(F.col("score"), confs).alias("cs")).agg(F.count("*").alias("n"))
    size = truth.groupBy(*by).agg(F.count("*").alias("n_true"))
    images = size.join(found.select(*by).distinct(), by)
    grid = spark.createDataFrame([(i, float(c), j, float(o)) for i, c in enumerate(sorted(confs)) for j, o in enumerate(sorted(ious))], "ci int, conf double, oi int, iou double")
    cells = images.join(F.broadcast(grid))
    hits = pairs.join(F.broadcast(grid), (F.col("cs") > F.col("ci")) & (F.col("os") > F.col("oi"))).groupBy(*by, "ci", "oi").agg(F.sum("n").alias("tp"))
    levels = F.broadcast(grid.select("ci").distinct())
    made = predicted.join(levels, F.col("cs") > F.col("ci")).groupBy(*by, "ci").agg(F.sum("n").alias("made"))
    rows = cells.join(hits, [*by, "ci", "oi"], "left").join(made, [*by, "ci"], "left").fillna(0, ["tp", "made"])
    fp, fn = F.col("made") - F.col("tp"), F.col("n_true") - F.col("tp")
    f1 = F.coalesce(F.try_divide(2.0 * F.col("tp"), 2 * F.col("tp") + fn + fp), F.lit(0.0))
    return rows.groupBy("conf", "iou").agg(F.avg(F.col("tp") / F.greatest("made", F.lit(1))).alias("precision"), F.avg(F.col("tp") / F.col("n_true")).alias("recall"), F.avg(f1).alias("f1"))
