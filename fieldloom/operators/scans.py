"""Running figures in a global order: range partitions, their totals, and prefix sums of the totals, so that no key has to fit into one task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..shared import written
from .grouped import changes

PART = "__part"


def in_ranges(rows: DataFrame, by: list[str], order: list[str | Column]) -> DataFrame:
    """`rows` as a table whose `__part` numbers ranges of (by, order) of about equal size; a key with many rows has many of them. The order must tell rows apart."""
    ranged = rows.repartitionByRange(*(F.col(c) for c in by), *order)
    return written(ranged.withColumn(PART, F.spark_partition_id()), "ranges")


def _with_totals(ranged: DataFrame, by: list[str], totals: DataFrame) -> DataFrame:
    own = totals.select(*(F.col(c).alias(f"__{c}") for c in by), F.col(PART).alias("__of"), *(c for c in totals.columns if c not in (*by, PART)))
    same = F.col(PART) == F.col("__of")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return ranged.join(own, same).drop("__of", *(f"__{c}" for c in by))


def running_sums(ranged: DataFrame, by: list[str], order: list[str | Column], values: dict[str, Column]) -> DataFrame:
    """`ranged` (of `in_ranges`) with a running sum of each value within `by`, the row itself included.

    Two passes: the totals of the parts, a row for each part and key, are summed up, and each part adds its own rows to what lies before it.
    """
    totals = ranged.groupBy(*by, PART).agg(*(F.sum(v).alias(f"__sum_{n}") for n, v in values.items()))
    before = Window.partitionBy(*by).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*by, PART, *(F.coalesce(F.sum(f"__sum_{n}").over(before), F.lit(0)).alias(f"__before_{n}") for n in values))
    own = Window.partitionBy(*by, PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = _with_totals(ranged, by, totals)
    sums = {n: F.col(f"__before_{n}") + F.sum(v).over(own) for n, v in values.items()}
    return out.withColumns(sums).drop(*(f"__before_{n}" for n in values))


def best_from_here(ranged: DataFrame, by: list[str], backwards: list[str | Column], value: str, name: str) -> DataFrame:
    """`ranged` with `name`, the greatest `value` of the row and all after it within `by`.

    `backwards` is the order read from its end, as a frame that grows costs a step for each row, and one that shrinks a step for each row left.
    """
    totals = ranged.groupBy(*by, PART).agg(F.max(value).alias("__most"))
    after = Window.partitionBy(*by).orderBy(F.col(PART).desc()).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*by, PART, F.max("__most").over(after).alias("__after"))  # a row for each part of a key
    own = Window.partitionBy(*by, PART).orderBy(*backwards).rowsBetween(Window.unboundedPreceding, 0)
    return _with_totals(ranged, by, totals).withColumn(name, F.greatest(F.max(value).over(own), "__after")).drop("__after")


def precision_curve(matched: DataFrame, by: list[str], order: list[str | Column]) -> DataFrame:
    """`matched` (hit 0/1, n_true) in order of falling score, with `tp` and `n` so far and `envelope`, the best precision from there on.

    The first figures are written, as the second scan reads them twice.
    """
    counted = running_sums(in_ranges(matched, by, order), by, order, {"tp": F.col("hit").cast("long"), "n": F.lit(1)})
    counted = written(counted.withColumn("precision", F.col("tp") / F.col("n")), "counted")
    return best_from_here(counted, by, [F.col("n").desc()], "precision", "envelope").drop(PART)


def average_precision(matched: DataFrame, by: list[str], order: list[str | Column]) -> DataFrame:
    """(by, ap): the area under the envelope over recall; a hit answers for the step of recall that it makes."""
    rows = precision_curve(matched, by, order)
    return rows.groupBy(*by).agg(F.sum(F.col("hit") * F.col("envelope") / F.col("n_true")).alias("ap"))


def recall_points(tp: str, n_true: str, points: int) -> Column:
    """The number of even recall points above 0 that so many hits reach, in whole numbers."""
    return F.expr(f"({tp} * {points - 1}) div {n_true}")


def point_precision(matched: DataFrame, by: list[str], order: list[str | Column], points: int = 101) -> DataFrame:
    """(by, ap): the mean of the envelope at `points` even recalls, 0 where no row reaches one. A row answers for the points above those of the row before and up to its own."""
    rows = precision_curve(matched, by, order)
    gained = recall_points("tp", "n_true", points) - recall_points("(tp - hit)", "n_true", points) + F.when(F.col("n") == 1, 1).otherwise(0)
    return rows.groupBy(*by).agg((F.sum(gained * F.col("envelope")) / points).alias("ap"))


def best_at_least(matched: DataFrame, by: list[str], order: list[str | Column], steps: int = 11) -> DataFrame:
    """(by, ap): the mean of the best precision at recalls of at least 0, 0.1, ... 1 (for 11 steps)."""
    counted = running_sums(in_ranges(matched, by, order), by, order, {"tp": F.col("hit").cast("long"), "n": F.lit(1)})
    precision = F.col("tp") / F.col("n")
    reached = lambda k: F.col("tp") * (steps - 1) >= k * F.col("n_true")
    best = counted.groupBy(*by).agg(*(F.coalesce(F.max(F.when(reached(k), precision)), F.lit(0.0)).alias(f"p{k}") for k in range(steps)))
    return best.select(*by, (sum((F.col(f"p{k}") for k in range(1, steps)), F.col("p0")) / steps).alias("ap"))


def _bits(masks: bytes, cells: int) -> np.ndarray:
    return (np.frombuffer(masks, np.int64)[:, None] >> np.arange(cells)) & 1


def curve_figures(rows: DataFrame, by: list[str], order: list[str | Column], n_true: DataFrame, cells: int, points: int | None = None, limits: tuple[int, ...] = ()) -> DataFrame:
    """(by, cell, ap, hits_N for each of `limits`): up to 63 precision curves over the same rows in one order, whose rows are not repeated for each curve.

    Of `counts` and `hits` (long), bit c tells whether the row counts in cell c, and whether it is a hit. `n_true` has an array of true figures by cell for each key;
    cells with 0 are left out. `ap` is the area under the envelope, or its mean at so many even recalls; hits_N counts the hits whose `rank` is N at most.

    Rows are put in order once and packed, a batch of rows to a row of masks, its place and its totals. Totals of batches are summed up, then their best
    precisions from the end; each batch is then told by itself. Keys that are null are left out.
    """
    names = [f.name for f in rows.schema if f.name in by]
    keys = ", ".join(f"{c} {dict(rows.dtypes)[c]}" for c in names)
    rank = F.col("rank").cast("long") if limits else F.lit(0).cast("long")
    ready = written(rows.withColumn("rank", rank), "matched")  # the ranges are found from a pass of their own
    ranged = ready.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order).select(*names, F.spark_partition_id().alias(PART), "counts", "hits", "rank")
    places = f"{keys}, {PART} int, chunk int"

    def pack(batches):
        chunk = 0
        for batch in batches:
            cuts = [0, *np.flatnonzero(changes(batch, names)).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                masks = [batch.column(c).slice(a, b - a).to_numpy(zero_copy_only=False).astype(np.int64).tobytes() for c in ("counts", "hits", "rank")]
                totals = [_bits(m, cells).sum(axis=0) for m in masks[:2]]
                heads = [batch.column(c).slice(a, 1) for c in (*names, PART)]
                yield pa.RecordBatch.from_arrays(
                    [*heads, pa.array([chunk], pa.int32()), *(pa.array([t.tolist()], pa.list_(pa.int64())) for t in totals), *(pa.array([m], pa.binary()) for m in masks)],
                    [*names, PART, "chunk", "n", "tp", "counts", "hits", "rank"],
                )
                chunk += 1

    packed = written(ranged.mapInArrow(pack, f"{places}, n array<long>, tp array<long>, counts binary, hits binary, rank binary"), "packed")
    at = [*names, PART, "chunk"]

    def by_cell(totals: DataFrame, figures: list[str], values: list[Column]) -> DataFrame:
        """Arrays of figures by cell, each computed in a window over the chunks of a key and cell."""
        out = totals.select(*at, "cell", *(v.alias(f) for v, f in zip(values, figures)))
        listed = out.groupBy(*at).agg(F.sort_array(F.collect_list(F.struct("cell", *figures))).alias("all"))
        return listed.select(*at, *(F.col(f"all.{f}").alias(f) for f in figures))

    before = Window.partitionBy(*names, "cell").orderBy(PART, "chunk").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*names, "cell").orderBy(F.col(PART).desc(), F.col("chunk").desc()).rowsBetween(Window.unboundedPreceding, -1)
    each = packed.select(*at, F.posexplode(F.arrays_zip("n", "tp")).alias("cell", "v")).select(*at, "cell", "v.n", "v.tp")
    offsets = written(by_cell(each, ["n0", "tp0"], [F.coalesce(F.sum(c).over(before), F.lit(0)) for c in ("n", "tp")]), "offsets")
    masks = packed.select(*at, "counts", "hits", "rank").join(offsets, at).join(n_true, names)

    def told(batch: pa.RecordBatch, k: int):
        counted, hit = (_bits(batch.column(c)[k].as_py(), cells) for c in ("counts", "hits"))
        n, tp = (np.array(batch.column(c)[k].as_py()) + v.cumsum(axis=0) for c, v in (("n0", counted), ("tp0", hit)))
        return counted, hit, n, tp, np.where(counted > 0, tp / np.maximum(n, 1), -1.0)

    def row(batch: pa.RecordBatch, k: int, more: list[tuple[str, pa.Array]], keep: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(batch.column(c).slice(k, 1) for c in keep), *(v for _, v in more)], [*keep, *(n for n, _ in more)])

    def best(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                yield row(batch, k, [("best", pa.array([told(batch, k)[4].max(axis=0).tolist()]))], at)

    most = masks.mapInArrow(best, f"{places}, best array<double>").select(*at, F.posexplode("best").alias("cell", "best"))
    most = written(by_cell(most, ["later"], [F.coalesce(F.max("best").over(after), F.lit(-1.0))]), "best")

    def figures(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                counted, hit, n, tp, precision = told(batch, k)
                true, later = (np.array(batch.column(c)[k].as_py()) for c in ("n_true", "later"))
                envelope = np.maximum(np.maximum.accumulate(precision[::-1], axis=0)[::-1], later)
                whole = np.maximum(true, 1)
                if points is None:
                    ap = (hit * envelope / whole).sum(axis=0)
                else:
                    # A row answers for the points above those of the row before and up to its own, in whole numbers.
                    gained = tp * (points - 1) // whole - (tp - hit) * (points - 1) // whole + ((n == 1) & (counted > 0))
                    ap = (gained * envelope).sum(axis=0) / points
                ranks = np.frombuffer(batch.column("rank")[k].as_py(), np.int64)
                hits = [(f"hits_{m}", pa.array([hit[ranks <= m].sum(axis=0).tolist()], pa.list_(pa.int64()))) for m in limits]
                yield row(batch, k, [("ap", pa.array([ap.tolist()])), *hits, ("n_true", batch.column("n_true").slice(k, 1))], names)

    made = ["ap", *(f"hits_{m}" for m in limits)]
    out = masks.join(most, at).mapInArrow(figures, f"{keys}, ap array<double>, {''.join(f'hits_{m} array<long>, ' for m in limits)}n_true array<long>")
    out = out.select(*names, F.posexplode(F.arrays_zip(*made, "n_true")).alias("cell", "v")).where("v.n_true > 0")
    return out.groupBy(*names, "cell").agg(*(F.sum(f"v.{c}").alias(c) for c in made))
