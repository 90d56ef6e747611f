"""Chat formatting: snapshots of growing conversations collapse to the longest one, by rolling hashes of turn prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise


def turn_markup(role: Column, text: Column) -> Column:
    """One rendered turn."""
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("<|im_end|>\n"))


def prefix_hashes(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, n_turns, role, text, ha, hb): turns in order, each with the 128-bit hash of all turns up to it.

    The hash of a prefix is the exclusive-or of seeded hashes of (place, role, text), so that it rolls on by one step a turn. A turn
    without conv_id is a conversation by itself, for which nothing is sorted.
    """
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = Window.partitionBy("conv_id")
    ordered = whole.orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    sofar = ordered.rowsBetween(Window.unboundedPreceding, 0)
    hashes = [F.xxhash64(F.lit(1), "at", "role", "text").alias("a"), F.xxhash64("text", "role", "at", F.lit(2)).alias("b")]
    known = turns.where("conv_id is not null").withColumn("at", F.row_number().over(ordered)).select("*", *hashes)
    known = known.select("conv_id", "at", F.count("*").over(whole).alias("n_turns"), "role", "text", F.bit_xor("a").over(sofar).alias("ha"), F.bit_xor("b").over(sofar).alias("hb"))
    alone = turns.where("conv_id is null").withColumn("at", F.lit(1)).select("*", *hashes)
    return known.unionByName(alone.select("conv_id", "at", F.lit(1).cast("long").alias("n_turns"), "role", "text", F.col("a").alias("ha"), F.col("b").alias("hb")))


def maximal_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies, rendered) of each conversation that is not the beginning of a longer one.

    Turns are ordered by turn (nulls first), role and text; a null role or text counts as empty; a row with a null conv_id is a conversation of
    one turn. Of equal conversations, the smallest conv_id stays (null only where all lack one) and n_copies counts them. Repeated
    rows are turns of their own. Extra columns are ignored; an empty table gives an empty result.

    Prefix hashes are written once. Ends and inner prefixes are made distinct where they are read before the anti-join meets them, so that
    a first turn which many conversations share is one row. One conversation's turns are sorted together and end in one row, so that a
    conversation is bounded by what a row can hold.
    """
    hashed = materialise(prefix_hashes(conversations), "prefixes")
    ends = hashed.where("at = n_turns").groupBy("ha", "hb", "n_turns").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    inner = hashed.where("at < n_turns").select("ha", "hb", F.col("at").cast("long").alias("n_turns")).distinct()
    kept = materialise(ends.join(inner, ["ha", "hb", "n_turns"], "left_anti"), "kept")
    line = lambda: turn_markup(F.col("role"), F.col("text"))
    turns = hashed.where("conv_id is not null").join(kept.select("conv_id", "n_copies"), "conv_id")
    whole = turns.groupBy("conv_id", "n_turns", "n_copies").agg(F.array_sort(F.collect_list(F.struct("at", line().alias("line")))).alias("lines"))
    whole = whole.select("conv_id", "n_turns", "n_copies", F.array_join(F.transform("lines", lambda x: x["line"]), "").alias("rendered"))
    alone = hashed.where("conv_id is null").select("ha", "hb", "n_turns", line().alias("rendered")).distinct()
    alone = kept.where("conv_id is null").join(alone, ["ha", "hb", "n_turns"]).select("conv_id", "n_turns", "n_copies", "rendered")
    return whole.unionByName(alone)


CHAT_SQL = """
WITH turns AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, alone, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id, alone ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS n
  FROM (SELECT *, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS alone FROM conversations)),
lines AS (SELECT conv_id, alone, n, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS line FROM turns),
prefixes AS (
  SELECT conv_id, n, string_agg(line, '') OVER (PARTITION BY conv_id, alone ORDER BY n ROWS UNBOUNDED PRECEDING) AS rendered,
         count(*) OVER (PARTITION BY conv_id, alone) AS n_turns
  FROM lines),
ends AS (SELECT min(conv_id) AS conv_id, n_turns, count(*) AS n_copies, rendered FROM prefixes WHERE n = n_turns GROUP BY n_turns, rendered)
SELECT conv_id, n_turns, n_copies, rendered FROM ends e
WHERE NOT EXISTS (SELECT 1 FROM prefixes p WHERE p.n < p.n_turns AND p.n = e.n_turns AND p.rendered = e.rendered)
"""
