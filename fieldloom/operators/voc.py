"""Matching of found boxes with true ones of which some are difficult, and the mean precision over classes and overlaps."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scans
from .grouped import fold_groups, near_pairs, numbers

#: The usual overlaps, 0.5 to 0.95.
OVERLAPS = [round(0.5 + 0.05 * k, 2) for k in range(10)]


def claims(truth: DataFrame, found: DataFrame, by: list[str], thresholds: list[float] | None = None) -> DataFrame:
    """(by, class, pos, score, counts, hits) of the found boxes; bit t of `counts` and `hits` (long) is for the threshold of that place.

    A found box looks at the true box of its class that it overlaps most (the first by pos of equals, edge pixels counted), and at no other. Where that
    overlap is above the threshold, it does not count if the true box is difficult, is a hit if it is the first by falling score (then pos) to
    claim it, and a miss otherwise. Boxes have by, class, pos, x1, y1, x2, y2; found ones a score, true ones `difficult` (0/1); `by` names the image.
    Boxes are shuffled once; a call takes many images.
    """
    key, limits = [*by, "class"], np.array(thresholds or OVERLAPS)
    box = [*key, "pos", *(F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2"))]
    none = F.lit(None).cast("double")
    score = dict(found.dtypes)["score"]
    true_rows = truth.select(*box, none.cast(score).alias("score"), F.lit(True).alias("true"), (F.coalesce("difficult", F.lit(0)) != 0).alias("difficult"))
    found_rows = found.select(*box, "score", F.lit(False).alias("true"), F.lit(False).alias("difficult"))
    kinds = {f.name: f.dataType.simpleString() for f in found_rows.schema}

    def fold(table, groups):
        x1, y1, x2, y2, pos, score = (numbers(table, c) for c in ("x1", "y1", "x2", "y2", "pos", "score"))
        true, difficult = (numbers(table, c).astype(bool) for c in ("true", "difficult"))
        size = (x2 - x1 + 1) * (y2 - y1 + 1)
        i, j = near_pairs(groups, x1, x2 + 1, lambda i, j: (true[i] != true[j]) & (np.minimum(y2[i], y2[j]) >= np.maximum(y1[i], y1[j])) & (np.minimum(x2[i], x2[j]) >= np.maximum(x1[i], x1[j])))
        f, t = np.where(true[i], j, i), np.where(true[i], i, j)
        common = (np.minimum(x2[f], x2[t]) - np.maximum(x1[f], x1[t]) + 1) * (np.minimum(y2[f], y2[t]) - np.maximum(y1[f], y1[t]) + 1)
        overlap = common / (size[f] + size[t] - common)
        order = np.lexsort((pos[t], -overlap, f))
        f, t, overlap = f[order], t[order], overlap[order]
        first = np.r_[True, f[1:] != f[:-1]][: len(f)]
        f, t, overlap = f[first], t[first], overlap[first]
        # Of the claimants of a true box in their order, one is the first at a threshold if no earlier one is above it.
        order = np.lexsort((pos[f], -score[f].astype(float), t))
        f, t, overlap = f[order], t[order], overlap[order]
        above = overlap[:, None] > limits[None, :]
        sums = above.cumsum(axis=0)
        starts = np.flatnonzero(np.r_[True, t[1:] != t[:-1]][: len(t)])
        offset = np.repeat((sums - above)[starts], np.diff(np.r_[starts, len(t)]), axis=0)
        bits = 1 << np.arange(len(limits), dtype=np.int64)
        counts, hits = np.full(len(pos), bits.sum()), np.zeros(len(pos), np.int64)
        counts[f] -= ((above & difficult[t][:, None]) * bits).sum(axis=1)
        hits[f] = ((above & ~difficult[t][:, None] & (sums - offset == 1)) * bits).sum(axis=1)
        own = np.flatnonzero(~true)
        out = table.select([*key, "pos", "score"]).take(own)
        return out.append_column("counts", pa.array(counts[own])).append_column("hits", pa.array(hits[own]))

    schema = ", ".join(f"{c} {kinds[c]}" for c in (*key, "pos", "score")) + ", counts long, hits long"
    return fold_groups(true_rows.unionByName(found_rows), key, fold, schema)


def matches(truth: DataFrame, found: DataFrame, by: list[str], thresholds: list[float] | None = None) -> DataFrame:
    """(by, class, pos, score, threshold, hit) of the found boxes that count, a row for each threshold; see `claims`."""
    steps = F.explode(F.array(*(F.struct(F.lit(t).alias("threshold"), F.lit(1 << k).cast("long").alias("bit")) for k, t in enumerate(thresholds or OVERLAPS))))
    each = claims(truth, found, by, thresholds).withColumn("step", steps).where(F.col("counts").bitwiseAND(F.col("step.bit")) != 0)
    return each.select(*by, "class", "pos", "score", "step.threshold", (F.col("hits").bitwiseAND(F.col("step.bit")) != 0).cast("int").alias("hit"))


def precisions(truth: DataFrame, found: DataFrame, by: list[str], thresholds: list[float] | None = None, eleven_points: bool = False) -> DataFrame:
    """(class, threshold, n_true, ap) for each class with true boxes that are not difficult; without a found box it is 0. A found box is one row for all thresholds."""
    thresholds = thresholds or OVERLAPS
    counts = truth.where("class is not null and coalesce(difficult, 0) = 0").groupBy("class").agg(F.count("*").alias("n_true"))
    order = [F.col("score").desc(), *(F.col(c) for c in (*by, "pos"))]
    ap = scans.curve_figures(claims(truth, found, by, thresholds), ["class"], order, counts.select("class", F.array_repeat("n_true", len(thresholds)).alias("n_true")), len(thresholds), 11 if eleven_points else None)
    cells = counts.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(len(thresholds) - 1))))
    joined = cells.join(ap, ["class", "cell"], "left")
    return joined.select("class", F.get(F.array(*map(F.lit, thresholds)), F.col("cell")).alias("threshold"), "n_true", F.coalesce("ap", F.lit(0.0)).alias("ap"))


def mean_precisions(cells: DataFrame) -> DataFrame:
    """(map_50, map_5095): the mean over classes at the least overlap, and over all overlaps."""
    means = cells.groupBy("threshold").agg(F.avg("ap").alias("ap"))
    return means.agg(F.min_by("ap", "threshold").alias("map_50"), F.avg("ap").alias("map_5095"))
