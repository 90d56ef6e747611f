"""Work ledgers: what was collected, analysed and uploaded, and what is left to do."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def pending(done: DataFrame, shipped: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `done` whose key is not in `shipped`; null keys equal each other, failed shipments count as present."""
    other = shipped.select(*(F.col(k).alias(f"__{k}") for k in keys)).distinct()
    return done.join(other, reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys)), "left_anti")


def next_pending(collected: DataFrame, analysed: DataFrame, keys: list[str], order: str, per: list[str]) -> DataFrame:
    """The first collected row of each group that is not analysed yet; one pass with a minimum for each group."""
    return pending(collected, analysed, keys).groupBy(*per).agg(F.min(order).alias(order))


def present(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is among the keys."""
    return rows.join(keys.select(*on).distinct(), on, "left_semi")


def upload_batches(rows: DataFrame, group: list[str], row: str, index: str) -> DataFrame:
    """For each group, a list of (row, sorted indices)."""
    inner = rows.groupBy(*group, row).agg(F.sort_array(F.collect_list(index)).alias("indices"))
    return inner.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct(row, "indices"))).alias("rows"))


def merged(old: DataFrame, new: DataFrame) -> DataFrame:
    """Both ledgers' distinct rows."""
    return old.unionByName(new).distinct()


def valid(rows: DataFrame) -> DataFrame:
    """Rows without any null."""
    return rows.dropna("any")


def first_of_key(rows: DataFrame, key: list[str], order: str | list[str]) -> DataFrame:
    """One row for each key, the first in order."""
    return rows.withColumn("__r", F.row_number().over(Window.partitionBy(*key).orderBy(*([order] if isinstance(order, str) else order)))).where("__r = 1").drop("__r")


def next_row_number(rows: DataFrame, by: list[str], number: str) -> DataFrame:
    """The number that follows the greatest one of each group."""
    return rows.groupBy(*by).agg((F.coalesce(F.max(number), F.lit(0)) + 1).alias("next_number"))


def composed_matches(first: DataFrame, second: DataFrame) -> DataFrame:
    """(a, b) and (b, c) matches joined to (a, c)."""
    return first.join(second, "b").select("a", "c")


def composite_key(columns: list[str], whole: str | None = None) -> Column:
    """One text of several columns; the column `whole` is brought to a whole number first, so that `01` and `1.0` agree."""
    parts = [F.expr(f"cast(try_cast({c} as double) as bigint)").cast("string") if c == whole else F.col(c).cast("string") for c in columns]
    return F.concat_ws("_", *parts)


def looked_up(rows: DataFrame, table: DataFrame, key: str, value: str, order: str, default=None) -> DataFrame:
    """`rows` with `value` of the table's last row of the key, by `order`; `default` where there is none."""
    last = table.groupBy(key).agg(F.max_by(value, order).alias(value))
    out = rows.join(last, key, "left")
    return out if default is None else out.withColumn(value, F.coalesce(value, F.lit(default)))


def first_looked_up(rows: DataFrame, table: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """`rows` that have a key in the table, with `value` of its first row by `order`."""
    return rows.join(table.groupBy(key).agg(F.min_by(value, order).alias(value)), key)


def inverted(pairs: DataFrame, key: str, value: str) -> DataFrame:
    """The map read backwards: for each value, the last key that has it."""
    return pairs.where(F.col(value).isNotNull()).groupBy(value).agg(F.max(key).alias(key))


def unmatched(left: DataFrame, right: DataFrame, matches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of (a) and of (c) that are in no match (a, c)."""
    return left.join(matches, "a", "left_anti"), right.join(matches, "c", "left_anti")


def with_offsets(parts: DataFrame, size: str, order: str) -> DataFrame:
    """`offset` of each part in their concatenation, one row for each part, and its end."""
    before = F.sum(size).over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    return parts.withColumn("offset", F.coalesce(before, F.lit(0))).withColumn("until", F.col("offset") + F.col(size))


def located_in_parts(indices: DataFrame, parts: DataFrame, index: str, size: str, order: str, most_parts: int = 100_000) -> DataFrame:
    """Global indices as (part, local): the parts' offsets, a row for each, are broadcast behind a check of their number."""
    if parts.limit(most_parts + 1).count() > most_parts:
        raise ValueError("too many parts to broadcast")
    spans = with_offsets(parts, size, order).select(F.col(order).alias("part"), "offset", "until")
    inside = (F.col(index) >= F.col("offset")) & (F.col(index) < F.col("until"))
    return indices.join(F.broadcast(spans), inside).select(*indices.columns, "part", (F.col(index) - F.col("offset")).alias("local"))
