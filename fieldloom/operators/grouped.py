"""Folds over many small groups of rows at once, and overlaps of boxes within them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import written

#: Groups of up to so many rows are folded whole; larger ones are cut by cells.
WHOLE = 1024


def changes(batch: pa.RecordBatch, by: list[str]) -> np.ndarray:
    """Whether a row's key differs from the row before; false for the first."""
    out = np.zeros(batch.num_rows, bool)
    for c in by:
        codes = pc.dictionary_encode(batch.column(c), null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        out[1:] |= codes[1:] != codes[:-1]
    return out


def _whole_groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups with each row's group, from sorted batches that cut groups anywhere."""
    held: list[pa.RecordBatch] = []
    key = lambda batch, k: [repr(batch.column(c)[k].as_py()) for c in by]

    def table() -> tuple[pa.Table, np.ndarray]:
        numbers, last = [], 0
        for k, batch in enumerate(held):
            own = changes(batch, by).cumsum() + last
            if k and key(held[k - 1], held[k - 1].num_rows - 1) != key(batch, 0):
                own += 1
            numbers.append(own)
            last = own[-1]
        return pa.Table.from_batches(held).combine_chunks(), np.concatenate(numbers)

    for batch in batches:
        if not batch.num_rows:
            continue
        starts = np.flatnonzero(changes(batch, by))
        if held and key(held[-1], held[-1].num_rows - 1) != key(batch, 0):
            starts = np.concatenate([[0], starts])
        if len(starts):
            cut = int(starts[-1])
            if cut:
                held.append(batch.slice(0, cut))
            if held:
                yield table()
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield table()


def fold_groups(rows: DataFrame, by: list[str], fold: Callable[[pa.Table, np.ndarray], pa.Table], schema) -> DataFrame:
    """`fold` over tables of many whole groups (rows that agree in `by`) with the group of each row, which rises from 0.

    Rows are shuffled and sorted by their group once; a call takes the groups that end in one batch, so that small groups cost no call of their own.
    """

    def run(batches):
        for table, groups in _whole_groups(batches, by):
            yield from fold(table, groups).to_batches(max_chunksize=50_000)

    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a number of our own, as folds cost more than their bytes tell
    return rows.repartition(tasks, *by).sortWithinPartitions(*by).mapInArrow(run, schema)


def parted(rows: DataFrame, by: list[str]) -> tuple[DataFrame | None, DataFrame | None]:
    """The rows of groups of up to `WHOLE` rows and those of larger ones; None where there are no larger (whole) groups. Rows with a null in `by` are in no group."""
    known = rows.dropna(subset=by) if by else rows
    if not by:
        return None, known
    large = written(known.groupBy(*by).agg(F.count("*").alias("__size")).where(F.col("__size") > WHOLE).select(*by), "large")
    if large.isEmpty():
        return known, None
    return known.join(large, by, "left_anti"), known.join(large, by, "left_semi")


def numbers(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).to_numpy()


def ranked(table: pa.Table, column: str) -> np.ndarray:
    """The place of each row's value among the different ones of the table, from 0; -1 for a null."""
    values = table.column(column).combine_chunks()
    return np.where(values.is_valid().to_numpy(zero_copy_only=False), pc.rank(values, "ascending", tiebreaker="dense").to_numpy().astype(np.int64) - 1, -1)


def near_steps(groups: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) of the rows of one group whose open intervals (low, high) meet, each pair once, in parts of no more pairs than there are rows.

    Rows are put in order of `low` and each looks at the next row, the one after it and so on while these begin before it ends.
    """
    order = np.lexsort((low, groups))
    g, lo, hi = groups[order], low[order], high[order]
    active, step = np.arange(len(order)), 1
    while len(active):
        active = active[active + step < len(order)]
        other = active + step
        fine = (g[active] == g[other]) & (lo[other] < hi[active])
        active, other = active[fine], other[fine]
        yield order[active], order[other]
        step += 1


def near_pairs(groups: np.ndarray, low: np.ndarray, high: np.ndarray, test: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of the pairs of `near_steps` for which `test(i, j)` holds: memory follows the rows and the pairs found, not the square of a group."""
    left, right = [], []
    for i, j in near_steps(groups, low, high):
        hit = test(i, j)
        left.append(i[hit])
        right.append(j[hit])
    empty = np.zeros(0, int)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])
