"""Counts of tracks by tree and row, and work ledgers."""

from pyspark.sql import functions as F

from ..operators import counting as C
from ..operators import ledger as L
from .tables import KEY, WITH_SLICES, WITH_TRACKS, read, slices, tracks

_CLOSED = """dense AS (
  SELECT g.scan_id, g.tree_id, g.frame, coalesce(s."start", -1) AS s0, coalesce(s."end", -1) AS e0
  FROM (SELECT scan_id, tree_id, unnest(range(lo, hi + 1)) AS frame FROM (SELECT scan_id, tree_id, min(frame) AS lo, max(frame) AS hi FROM slices GROUP BY ALL)) g
  LEFT JOIN slices s ON s.scan_id = g.scan_id AND s.tree_id = g.tree_id AND s.frame = g.frame),
closed AS (SELECT scan_id, tree_id, frame, CASE WHEN s0 = -1 THEN 0 ELSE s0 END AS s, CASE WHEN e0 = -1 THEN 1535 ELSE e0 END AS e FROM dense)"""

TREE_COUNT = f"""{WITH_TRACKS}, {WITH_SLICES}, {_CLOSED},
seen AS (SELECT c.scan_id, c.tree_id, track_id, count(*) AS n FROM tracks t JOIN closed c ON t.scan_id = c.scan_id AND t.frame = c.frame AND x1 > s AND x2 < e GROUP BY ALL),
trees AS (SELECT DISTINCT scan_id, tree_id FROM slices)
SELECT scan_id, tree_id, CAST(count(*) FILTER (n >= 1) AS BIGINT) AS cv1, CAST(count(*) FILTER (n >= 2) AS BIGINT) AS cv2, CAST(count(*) FILTER (n >= 3) AS BIGINT) AS cv3
FROM trees LEFT JOIN seen USING (scan_id, tree_id) GROUP BY ALL"""


def _done(spark, d):
    return read(spark, d, "orders").where("o_orderstatus = 'F'").select("o_custkey", "o_orderkey")


def _shipped(spark, d):
    return read(spark, d, "orders").where("o_orderkey % 3 = 0").select("o_custkey", "o_orderkey")


def _first_lines(spark, d):
    """Of an order's lines with the same number, the one that comes first in the table."""
    rows = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return L.first_of_key(rows, ["l_orderkey"], ["l_linenumber", "file", "row"]).drop("file", "row")


QUERIES = {
    "tree_count_k": (lambda s, d: C.tree_counts(tracks(s, d), slices(s, d), KEY), TREE_COUNT),
    "tree_count_overlap": (
        lambda s, d: C.tree_counts_overlap(tracks(s, d), slices(s, d), KEY),
        f"""{WITH_TRACKS}, {WITH_SLICES} SELECT t.scan_id, tree_id, count(DISTINCT track_id) AS cv FROM tracks t JOIN slices s ON t.scan_id = s.scan_id AND t.frame = s.frame
        AND ("start" = -1 OR "start" < x2) AND ("end" = -1 OR "end" > x1) GROUP BY ALL""",
    ),
    "row_count_filters": (
        lambda s, d: C.row_counts(tracks(s, d), KEY, 3.0, 2),
        f"""{WITH_TRACKS}, per AS (SELECT scan_id, track_id, count(*) AS n, bool_or(depth < 3) AS near FROM tracks GROUP BY ALL)
        SELECT scan_id, count(*) AS n_all, count(*) FILTER (near) AS n_depth, count(*) FILTER (n >= 2) AS n_seen, count(*) FILTER (near AND n >= 2) AS n_both FROM per GROUP BY ALL""",
    ),
    "track_depth_counts": (
        lambda s, d: C.sighting_counts(tracks(s, d), KEY, 5.0),
        f"""{WITH_TRACKS}, kept AS (SELECT * FROM tracks WHERE depth IS NULL OR depth <= 5), per AS (SELECT scan_id, track_id, count(*) AS c FROM kept GROUP BY ALL),
        o AS (SELECT scan_id, count(*) AS n, count(*) FILTER (c > 1) AS over1, count(*) FILTER (c > 2) AS over2, count(*) FILTER (c > 3) AS over3, count(*) FILTER (c > 4) AS over4 FROM per GROUP BY ALL)
        SELECT o.*, n_dets, n_dropped FROM o JOIN (SELECT scan_id, count(*) AS n_dets, max(frame) + 1 - count(DISTINCT frame) AS n_dropped FROM kept GROUP BY ALL) USING (scan_id)""",
    ),
    "depth_cv": (
        lambda s, d: C.depth_counts(tracks(s, d), KEY, 3.0),
        f"""{WITH_TRACKS}, per AS (SELECT scan_id, track_id, count(*) AS c FROM tracks WHERE depth <= 3 GROUP BY ALL)
        SELECT scan_id, count(*) FILTER (c > 0) AS dcv1, count(*) FILTER (c > 1) AS dcv2, count(*) FILTER (c > 2) AS dcv3, count(*) FILTER (c > 3) AS dcv4, count(*) FILTER (c > 4) AS dcv5 FROM per GROUP BY ALL""",
    ),
    "dense_relabel": (
        lambda s, d: C.dense_ids(tracks(s, d), KEY),
        f"{WITH_TRACKS} SELECT scan_id, track_id, row_number() OVER (PARTITION BY scan_id ORDER BY track_id) - 1 AS new_id FROM (SELECT DISTINCT scan_id, track_id FROM tracks)",
    ),
    "densify_slices": (
        lambda s, d: C.densify(slices(s, d).where("frame % 3 <> 1"), KEY),
        f"""WITH {WITH_SLICES}, part AS (SELECT * FROM slices WHERE frame % 3 <> 1),
        g AS (SELECT scan_id, tree_id, unnest(range(lo, hi + 1)) AS frame FROM (SELECT scan_id, tree_id, min(frame) AS lo, max(frame) AS hi FROM part GROUP BY ALL))
        SELECT g.scan_id, g.tree_id, g.frame, coalesce("start", -1) AS "start", coalesce("end", -1) AS "end" FROM g LEFT JOIN part s ON s.scan_id = g.scan_id AND s.tree_id = g.tree_id AND s.frame = g.frame""",
    ),
    "new_ids": (
        lambda s, d: C.new_per_frame(tracks(s, d), KEY),
        f"""{WITH_TRACKS}, f AS (SELECT scan_id, track_id, min(frame) AS frame FROM tracks GROUP BY ALL), g AS (SELECT DISTINCT scan_id, frame FROM tracks)
        SELECT g.scan_id, g.frame, count(f.track_id) AS n_new FROM g LEFT JOIN f ON f.scan_id = g.scan_id AND f.frame = g.frame GROUP BY ALL""",
    ),
    "merged_counts": (
        lambda s, d: C.merged_counts([C.tree_counts_overlap(tracks(s, d), slices(s, d), KEY), tracks(s, d).groupBy("scan_id", "class").agg(F.count("*").alias("cv")).select("scan_id", F.col("class").alias("tree_id"), "cv")], ["scan_id"], "cv"),
        f"""{WITH_TRACKS}, {WITH_SLICES}, a AS (SELECT t.scan_id, tree_id, count(DISTINCT track_id) AS cv FROM tracks t JOIN slices s ON t.scan_id = s.scan_id AND t.frame = s.frame
        AND ("start" = -1 OR "start" < x2) AND ("end" = -1 OR "end" > x1) GROUP BY ALL), b AS (SELECT scan_id, class, count(*) AS cv FROM tracks GROUP BY ALL)
        SELECT scan_id, CAST(sum(cv) AS BIGINT) AS cv FROM (SELECT scan_id, cv FROM a UNION ALL SELECT scan_id, cv FROM b) GROUP BY ALL""",
    ),
    "ledger_anti": (
        lambda s, d: L.pending(_done(s, d), _shipped(s, d), ["o_custkey", "o_orderkey"]),
        "SELECT o_custkey, o_orderkey FROM orders o WHERE o_orderstatus = 'F' AND NOT EXISTS (SELECT 1 FROM orders u WHERE u.o_orderkey % 3 = 0 AND u.o_custkey IS NOT DISTINCT FROM o.o_custkey AND u.o_orderkey IS NOT DISTINCT FROM o.o_orderkey)",
    ),
    "ledger_next": (
        lambda s, d: L.next_pending(read(s, d, "orders").select("o_custkey", "o_orderkey"), _done(s, d), ["o_custkey", "o_orderkey"], "o_orderkey", ["o_custkey"]),
        "SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders WHERE o_orderstatus <> 'F' GROUP BY ALL",
    ),
    "ledger_semi": (
        lambda s, d: L.present(read(s, d, "lineitem").select("l_orderkey", "l_linenumber"), _shipped(s, d).select(F.col("o_orderkey").alias("l_orderkey")), ["l_orderkey"]),
        "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0)",
    ),
    "upload_groups": (
        lambda s, d: L.upload_batches(read(s, d, "orders").select("o_custkey", "o_orderpriority", "o_orderkey"), ["o_custkey"], "o_orderpriority", "o_orderkey").select("o_custkey", F.to_json("rows").alias("rows_json")),
        """WITH i AS (SELECT o_custkey, o_orderpriority, list(o_orderkey ORDER BY o_orderkey) AS idx FROM orders GROUP BY ALL)
        SELECT o_custkey, '[' || string_agg('{"o_orderpriority":"' || o_orderpriority || '","indices":[' || array_to_string(idx, ',') || ']}', ',' ORDER BY o_orderpriority) || ']' AS rows_json FROM i GROUP BY ALL""",
    ),
    "union_distinct": (
        lambda s, d: L.merged(_done(s, d), _shipped(s, d)),
        "SELECT o_custkey, o_orderkey FROM orders WHERE o_orderstatus = 'F' UNION SELECT o_custkey, o_orderkey FROM orders WHERE o_orderkey % 3 = 0",
    ),
    "valid_rows": (
        lambda s, d: L.valid(read(s, d, "orders").select("o_orderkey", F.expr("nullif(o_custkey % 7, 0)").alias("plot"))),
        "SELECT o_orderkey, nullif(o_custkey % 7, 0) AS plot FROM orders WHERE o_custkey % 7 <> 0",
    ),
    "union_keep_first": (
        _first_lines,
        "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) = 1",
    ),
    "next_row_number": (
        lambda s, d: L.next_row_number(read(s, d, "lineitem"), ["l_orderkey"], "l_linenumber").withColumn("next_number", F.col("next_number").cast("long")),
        "SELECT l_orderkey, CAST(max(l_linenumber) + 1 AS BIGINT) AS next_number FROM lineitem GROUP BY ALL",
    ),
    "merge_matches": (
        lambda s, d: L.composed_matches(read(s, d, "orders").select(F.col("o_orderkey").alias("a"), F.col("o_custkey").alias("b")), read(s, d, "customer").select(F.col("c_custkey").alias("b"), F.col("c_nationkey").alias("c"))),
        "SELECT o_orderkey AS a, c_nationkey AS c FROM orders JOIN customer ON o_custkey = c_custkey",
    ),
}
