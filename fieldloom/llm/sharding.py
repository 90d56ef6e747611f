"""Contiguous shards of nearly equal bytes, cut on global prefix sums that come from per-partition totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise


_KEYS = ["doc_id", "size", "text_crc32"]


def _keyed(docs: DataFrame) -> list:
    return [
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")).alias("text_crc32"),
    ]


def _placed(keyed: DataFrame, shards: int) -> DataFrame:
    """Rows in order of the keys, with `begins`, `shard` and `slot`; other columns travel along."""
    ranged = materialise(keyed.repartitionByRange(*_KEYS).withColumn("__part", F.spark_partition_id()), "ranged")
    totals = ranged.groupBy("__part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # over one row for each partition
    starts = totals.select("__part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("__bytes"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("__rows"), F.sum("bytes").over(Window.partitionBy()).alias("__total"))
    own = Window.partitionBy("__part").orderBy(*_KEYS)
    own_bytes, own_rows = F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"), F.row_number().over(own) - 1
    placed = ranged.select("*", own_bytes.alias("__own_bytes"), own_rows.alias("__own_rows")).join(F.broadcast(starts), "__part")
    placed = placed.withColumn("begins", F.col("__bytes") + F.col("__own_bytes")).withColumn("__at", F.col("__rows") + F.col("__own_rows"))
    placed = placed.withColumn("shard", F.expr(f"cast((begins * {shards}) div __total as int)"))
    placed = materialise(placed.select(*keyed.columns, "begins", "__at", "shard"), "placed")
    first = placed.groupBy("shard").agg(F.min("__at").alias("__first"))  # one row for each shard
    return placed.join(F.broadcast(first), "shard").select(*keyed.columns, "shard", (F.col("__at") - F.col("__first")).alias("slot"), "begins")


def byte_shards(docs: DataFrame, shards: int = 16) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, begins) for each row of `docs` (doc_id, text; other columns are ignored).

    size is the UTF-8 length of the text (null: 0) plus 1. Documents are ordered by doc_id, then size and checksum (nulls
    first), and `begins` is the sum of sizes before each; a document goes to shard floor(begins * shards / total), so that
    the shards are contiguous, and each one's bytes differ from an equal share by less than one document at either end. slot counts the
    documents of a shard from 0. Repeated rows are all kept; an empty table gives an empty result.

    Only ids, sizes and checksums are shuffled, once, by range; what is gathered is a total for each partition.
    """
    return _placed(docs.select(*_keyed(docs)), shards)


def write_shards(docs: DataFrame, path: str, shards: int = 16) -> DataFrame:
    """Writes the documents below `path` in folders shard=0, 1, ..., each in slot order within its files, and returns the placing.

    Whole rows are placed, so that rows of one id, size and checksum keep their own columns; a shuffle by (shard, slot / 10000)
    brings each to its files, so that no task holds a whole shard. The files have the columns of `docs` and `slot`; a column of `docs`
    named slot or shard is written as doc_slot or doc_shard.
    """
    taken = {c: f"doc_{c}" for c in ("slot", "shard") if c in docs.columns}
    row = F.struct(*(F.col(c).alias(taken.get(c, c)) for c in docs.columns)).alias("__row")
    placed = materialise(_placed(docs.select(*_keyed(docs), row), shards), "sharded")
    out = placed.repartition("shard", F.expr("slot div 10000")).sortWithinPartitions("shard", "slot")
    out.select("__row.*", "slot", "shard").write.partitionBy("shard").parquet(path)
    return placed.drop("__row")
