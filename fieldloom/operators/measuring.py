"""Sizes and densities from depth and pixels, outliers, ellipsoids, quantiles from counts, greedy evaluation."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .grouped import fold_groups, near_pairs, numbers


def real_size(boxes: DataFrame, focal: float) -> DataFrame:
    """Width and height in the units of depth, by the pinhole model; boxes without depth have none."""
    per_pixel = F.col("depth") / focal
    return boxes.withColumns({"real_width": (F.col("x2") - F.col("x1")) * per_pixel, "real_height": (F.col("y2") - F.col("y1")) * per_pixel})


def within_deviations(rows: DataFrame, by: list[str], values: list[str], n: float) -> DataFrame:
    """Rows whose values all lie within `n` deviations (of the population) of their group's median. Two passes: the groups' figures are joined back."""
    figures = rows.groupBy(*by).agg(*(f for v in values for f in (F.percentile(v, 0.5).alias(f"__m_{v}"), F.stddev_pop(v).alias(f"__s_{v}"))))
    joined = rows.join(figures, by)
    for v in values:
        joined = joined.where(F.abs(F.col(v) - F.col(f"__m_{v}")) <= n * F.col(f"__s_{v}"))
    return joined.select(*rows.columns)


def densities(boxes: DataFrame, by: list[str], bandwidth: float) -> DataFrame:
    """`density` of each box's centre: the mean of a Gaussian kernel over all boxes of its frame, itself included."""
    from .density import kernel_means

    centre = boxes.select(*by, "pos", ((F.col("x1") + F.col("x2")) / 2).alias("cx"), ((F.col("y1") + F.col("y2")) / 2).alias("cy"))
    scaled = centre.withColumns({"__x": F.col("cx") / bandwidth, "__y": F.col("cy") / bandwidth})
    return kernel_means(scaled, by, ["__x", "__y"]).select(*by, "pos", "cx", "cy", "density")


def distinct_densities(boxes: DataFrame, by: list[str], bandwidth: float, decimals: int) -> DataFrame:
    """(by, pos, density) of `densities`, rounded, each different row once."""
    from .density import distinct_means

    centre = boxes.select(*by, "pos", ((F.col("x1") + F.col("x2")) / 2).alias("cx"), ((F.col("y1") + F.col("y2")) / 2).alias("cy"))
    return distinct_means(centre, by, "pos", ["cx", "cy"], bandwidth, decimals)


def quantile_bin(hist: DataFrame, by: list[str], share: float) -> DataFrame:
    """The first bin at which the counts from below reach a share of all."""
    w = Window.partitionBy(*by).orderBy("bin")
    rows = hist.select(*by, "bin", F.sum("n").over(w).alias("below"), F.sum("n").over(Window.partitionBy(*by)).alias("all"))
    return rows.where(F.col("below") >= share * F.col("all")).groupBy(*by).agg(F.min("bin").alias("bin"))


def nearest_mean(rows: DataFrame, by: list[str], value: str, k: int) -> DataFrame:
    """Mean of a group's `k` smallest values."""
    w = Window.partitionBy(*by).orderBy(value)
    return rows.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= k).groupBy(*by).agg(F.avg(value).alias("nearest"))


def hashed_sample(rows: DataFrame, by: list[str], key: str, k: int, seed: str = "s") -> DataFrame:
    """`k` rows of each group: those of the smallest md5 of seed and key, the same in every run."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")))
    return rows.withColumn("__d", digest).withColumn("__r", F.row_number().over(Window.partitionBy(*by).orderBy("__d", key))).where(F.col("__r") <= k).drop("__d", "__r")


def ellipsoids(points: DataFrame, by: list[str]) -> DataFrame:
    """(by, cx, cy, cz, rx, ry, rz) of the axis-parallel ellipsoid a x² + b y² + c z² + d x + e y + f z = 1 of least squares.

    The sums of products are aggregated where the points are; only a 6 x 6 system for each group is solved in Python.
    """
    terms = {"a": F.col("x") * F.col("x"), "b": F.col("y") * F.col("y"), "c": F.col("z") * F.col("z"), "d": F.col("x"), "e": F.col("y"), "f": F.col("z")}
    names = list(terms)
    sums = points.groupBy(*by).agg(*(F.sum(terms[p] * terms[q]).alias(f"{p}{q}") for i, p in enumerate(names) for q in names[i:]), *(F.sum(terms[p]).alias(f"s{p}") for p in names))
    kinds = dict(points.dtypes)

    def solve(parts):
        for pdf in parts:
            out = {c: pdf[c] for c in by} | {n: [] for n in ("cx", "cy", "cz", "rx", "ry", "rz")}
            for _, r in pdf.iterrows():
                m = np.array([[r[f"{min(p, q)}{max(p, q)}"] for q in names] for p in names], float)
                v = np.linalg.lstsq(m, np.array([r[f"s{p}"] for p in names], float), rcond=None)[0]
                centre = -v[3:] / (2 * v[:3])
                radius = np.sqrt(np.abs((1 + (v[:3] * centre**2).sum()) / v[:3]))
                for n, x in zip(("cx", "cy", "cz", "rx", "ry", "rz"), [*centre, *radius]):
                    out[n].append(float(x))
            yield pd.DataFrame(out)

    return sums.mapInPandas(solve, ", ".join(f"{c} {kinds[c]}" for c in by) + ", cx double, cy double, cz double, rx double, ry double, rz double")


def greedy_states(truth: DataFrame, found: DataFrame, by: list[str], thresholds: list[float], most: int = 100) -> DataFrame:
    """(by, class, pos, score, counts, hits): found boxes of a frame, by falling score, each take the best true box of their class that is free and overlaps enough.

    Bit t of `hits` (long) is for the threshold of that place; in `counts` all are set. Boxes are shuffled once; a call takes many frames.
    """
    key, limits, cells = [*by, "class"], [float(t) for t in thresholds], len(thresholds)
    if cells > 63:
        raise ValueError("at most 63 thresholds have a bit")
    side = lambda boxes, score, true: boxes.select(*key, "pos", *(F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")), score.cast("double").alias("score"), F.lit(true).alias("true"))
    rows = side(truth.dropna(subset=key), F.lit(None), True).unionByName(side(found, F.col("score"), False))
    kinds = dict(rows.dtypes)

    def fold(table: pa.Table, groups: np.ndarray) -> pa.Table:
        x1, y1, x2, y2, pos, score = (numbers(table, c) for c in ("x1", "y1", "x2", "y2", "pos", "score"))
        true, size = numbers(table, "true").astype(bool), (x2 - x1) * (y2 - y1)
        own = np.flatnonzero(~true)
        own = own[np.lexsort((pos[own], -score[own], groups[own]))]
        rank = np.arange(len(own)) - np.searchsorted(groups[own], groups[own])
        own = own[rank < most]
        place = np.full(len(pos), -1)
        place[own] = np.arange(len(own))
        i, j = near_pairs(groups, x1, x2, lambda i, j: (true[i] != true[j]) & (np.minimum(y2[i], y2[j]) > np.maximum(y1[i], y1[j])) & (np.minimum(x2[i], x2[j]) > np.maximum(x1[i], x1[j])))
        f, t = np.where(true[i], j, i), np.where(true[i], i, j)
        common = (np.minimum(x2[f], x2[t]) - np.maximum(x1[f], x1[t])) * (np.minimum(y2[f], y2[t]) - np.maximum(y1[f], y1[t]))
        overlap = common / (size[f] + size[t] - common)
        kept = (place[f] >= 0) & (overlap >= min(limits))
        f, t, overlap = place[f[kept]], t[kept], overlap[kept]
        order = np.lexsort((pos[t], -overlap, f))
        hits, taken = np.zeros(len(own), np.int64), {}
        for d, true_box, share in zip(f[order].tolist(), t[order].tolist(), overlap[order].tolist()):
            # The best comes first: a threshold is met by the first box that is free at it.
            bits = sum(1 << k for k, limit in enumerate(limits) if share >= limit) & ~taken.get(true_box, 0) & ~int(hits[d])
            hits[d] |= bits
            taken[true_box] = taken.get(true_box, 0) | bits
        out = table.select([*key, "pos", "score"]).take(pa.array(own, pa.int64()))
        return out.append_column("counts", pa.array(np.full(len(own), (1 << cells) - 1, np.int64))).append_column("hits", pa.array(hits))

    return fold_groups(rows, key, fold, ", ".join(f"{c} {kinds[c]}" for c in (*key, "pos")) + ", score double, counts long, hits long")


def greedy_hits(truth: DataFrame, found: DataFrame, by: list[str], thresholds: list[float], most: int = 100) -> DataFrame:
    """(by, class, pos, score, threshold, hit): a row for each threshold; see `greedy_states`."""
    steps = F.explode(F.array(*(F.struct(F.lit(float(t)).alias("threshold"), F.lit(1 << k).cast("long").alias("bit")) for k, t in enumerate(thresholds))))
    each = greedy_states(truth, found, by, thresholds, most).withColumn("step", steps)
    return each.select(*by[:-1], "class", by[-1], "pos", "score", "step.threshold", (F.col("hits").bitwiseAND(F.col("step.bit")) != 0).cast("int").alias("hit"))


def recall_point_precision(hits: DataFrame, truth: DataFrame, points: int = 101) -> DataFrame:
    """(class, threshold, ap): mean of the precision envelope at `points` even recalls, of the classes and thresholds with found boxes."""
    from .scans import point_precision

    total = truth.groupBy("class").agg(F.count("*").alias("n_true"))
    names = [c for c in hits.columns if c not in ("class", "threshold", "score", "hit")]
    return point_precision(hits.join(total, "class"), ["class", "threshold"], [F.col("score").desc(), *(F.col(c) for c in ["pos", *(n for n in names if n != "pos")])], points)


def greedy_precision(truth: DataFrame, found: DataFrame, by: list[str], thresholds: list[float], points: int = 101) -> DataFrame:
    """`recall_point_precision` of `greedy_hits`; a found box is one row for all thresholds."""
    from .scans import curve_figures

    order = [F.col("score").desc(), F.col("pos"), *(F.col(c) for c in by)]
    n_true = truth.groupBy("class").agg(F.array_repeat(F.count("*"), len(thresholds)).alias("n_true"))
    cells = curve_figures(greedy_states(truth, found, by, thresholds), ["class"], order, n_true, len(thresholds), points)
    return cells.select("class", F.get(F.array(*(F.lit(float(t)) for t in thresholds)), F.col("cell")).alias("threshold"), "ap")


def keypoint_similarity(pairs: DataFrame, variance: float) -> DataFrame:
    """`oks` of arrays of true and found points (x, y) and an object's area: the mean of exp(-d² / (2 area (2 variance)²))."""
    each = F.zip_with("truth", "found", lambda a, b: F.exp(-(F.pow(a["x"] - b["x"], 2) + F.pow(a["y"] - b["y"], 2)) / (2 * F.col("area") * (2 * variance) ** 2)))
    return pairs.withColumn("oks", F.try_divide(F.aggregate(each, F.lit(0.0), lambda s, v: s + v), F.size("truth")))


def with_depth_of(detections: DataFrame, pixels: DataFrame, by: list[str], most: float | None = None) -> DataFrame:
    """`depth` of each detection: the median of its valid pixels; with `most`, detections deeper than that or without depth go."""
    known = F.when(~F.isnan("z"), F.col("z"))
    out = detections.join(pixels.groupBy(*by).agg(F.percentile(known, 0.5).alias("depth")), by, "left")
    return out if most is None else out.where(F.col("depth").isNotNull() & (F.col("depth") <= most))


def below_edge(boxes: DataFrame, edges: DataFrame, by: list[str], column: str = "y1", bias: float = 0.0) -> DataFrame:
    """Boxes that begin below the mean height of their frame's edge pixels (y over 0), moved by `bias`."""
    limit = edges.where("y > 0").groupBy(*by).agg((F.avg("y") + bias).alias("__limit"))
    return boxes.join(limit, by).where(F.col(column) > F.col("__limit")).drop("__limit")


def near_mode(rows: DataFrame, by: list[str], value: str, low: float, high: float, bins: int, n: float) -> DataFrame:
    """Rows within `n` deviations (of the population) of the fullest bin's lower edge."""
    place = F.floor((F.col(value) - low) * bins / (high - low)).cast("int")
    counts = rows.groupBy(*by, place.alias("__bin")).agg(F.count("*").alias("__n"))
    mode = counts.groupBy(*by).agg(F.max_by("__bin", F.struct("__n", -F.col("__bin"))).alias("__mode"))
    spread = rows.groupBy(*by).agg(F.stddev_pop(value).alias("__std"))
    edge = F.lit(low) + F.col("__mode") * (high - low) / bins
    return rows.join(mode, by).join(spread, by).where(F.abs(F.col(value) - edge) <= n * F.col("__std")).select(*rows.columns)


def top_of_group(rows: DataFrame, by: list[str], order: list, k: int) -> DataFrame:
    """The first k rows of each group in an order."""
    return rows.withColumn("__r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("__r") <= k).drop("__r")
