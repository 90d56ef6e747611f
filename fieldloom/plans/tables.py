"""Field-scan tables derived from the driver's tables by integer arithmetic, the same in Spark and in DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Order keys and line numbers repeat: a box's number is that of its order and its place among the order's lines, so that no two boxes share one.
LINES = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
POS = f"CAST(l_orderkey * 1000 + row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LINES[1:])}) AS BIGINT)"
#: Columns over numbered lines; `DIV` stands for integer division.
TRACKS = """CAST(l_orderkey % 5 AS BIGINT) AS scan_id, CAST(l_orderkey % 200 AS BIGINT) AS frame, CAST(l_partkey % 400 AS BIGINT) AS track_id,
pos,
CAST((l_suppkey*37 + l_linenumber*101 + l_partkey*13) % 1400 AS BIGINT) AS x1, CAST((l_suppkey*37 + l_linenumber*101 + l_partkey*13) % 1400 + 20 + (l_partkey % 60) AS BIGINT) AS x2,
CAST((l_partkey*29 + l_linenumber*53) % 1900 AS BIGINT) AS y1, CAST((l_partkey*29 + l_linenumber*53) % 1900 + 20 + (l_suppkey % 60) AS BIGINT) AS y2,
CAST((l_partkey*7 + l_linenumber*11) % 800 AS DOUBLE) / 100 AS depth, CAST(l_suppkey % 100 AS DOUBLE) / 100 AS score, CAST(l_partkey % 3 AS BIGINT) AS class"""
#: Columns over lineitem for questions within a frame: frames of about 64 boxes, and scans of 100 frames, whose number grows with the data.
BOXES = TRACKS.replace("CAST(l_orderkey % 5 AS BIGINT) AS scan_id, CAST(l_orderkey % 200 AS BIGINT) AS frame", "CAST(l_orderkey DIV 1600 AS BIGINT) AS scan_id, CAST((l_orderkey DIV 16) % 100 AS BIGINT) AS frame")
#: Columns over orders; rows are then made distinct.
SLICES = """CAST(o_orderkey % 5 AS BIGINT) AS scan_id, CAST(o_orderkey % 200 AS BIGINT) AS frame, CAST((o_orderkey % 200) DIV 20 AS BIGINT) AS tree_id,
CAST(CASE WHEN (o_orderkey % 200) % 20 = 0 THEN -1 ELSE ((o_orderkey % 200) % 20)*30 END AS BIGINT) AS QQstartQQ,
CAST(CASE WHEN (o_orderkey % 200) % 20 = 19 THEN -1 ELSE 900 + ((o_orderkey % 200) % 20)*30 END AS BIGINT) AS QQendQQ"""
#: Columns over customer: points near a plot.
POINTS = """CAST(c_custkey % 20 AS BIGINT) AS scan_id, CAST(c_custkey AS BIGINT) AS place, 32 + CAST(c_custkey % 1000 AS DOUBLE) / 100000 AS lat, 35 + CAST((c_custkey * 7) % 1000 AS DOUBLE) / 100000 AS lon"""
KEY = ["scan_id"]


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _columns(text: str, engine: str) -> str:
    return text.replace("DIV", "div" if engine == "spark" else "//").replace("QQ", "`" if engine == "spark" else '"')


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "lineitem").select(*LINES, F.expr(POS).alias("pos"))


def tracks(spark: SparkSession, d: str) -> DataFrame:
    return _selected(_lines(spark, d), TRACKS)


def boxes(spark: SparkSession, d: str) -> DataFrame:
    return _selected(_lines(spark, d), BOXES)


def slices(spark: SparkSession, d: str) -> DataFrame:
    return _selected(read(spark, d, "orders").select("o_orderkey"), SLICES).distinct()


def points(spark: SparkSession, d: str) -> DataFrame:
    return _selected(read(spark, d, "customer").select("c_custkey"), POINTS)


def _selected(rows: DataFrame, columns: str) -> DataFrame:
    parts, depth, now = [], 0, ""
    for c in _columns(columns, "spark"):
        depth += (c == "(") - (c == ")")
        if c == "," and depth == 0:
            parts.append(now)
            now = ""
        else:
            now += c
    return rows.selectExpr(*parts, now)


def events(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events")


def frames_and_fixes(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Clicks as frames and views as position fixes of the same user."""
    e = events(spark, d)
    frames = e.where("event_type = 'click'").select("user_id", "ts", "event_id")
    return frames, e.where("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("fix"))


_LINES_SQL = f"WITH RECURSIVE lines AS MATERIALIZED (SELECT {', '.join(LINES)}, {POS} AS pos FROM lineitem)"
WITH_TRACKS = f"{_LINES_SQL}, tracks AS (SELECT {_columns(TRACKS, 'duckdb')} FROM lines)"
WITH_BOXES = f"{_LINES_SQL}, boxes AS MATERIALIZED (SELECT {_columns(BOXES, 'duckdb')} FROM lines)"
WITH_SLICES = f"slices AS (SELECT DISTINCT {_columns(SLICES, 'duckdb')} FROM orders)"
WITH_POINTS = f"WITH points AS (SELECT {_columns(POINTS, 'duckdb')} FROM customer)"

#: Plots as rings of (lon, lat), in order; the first that holds a point wins.
PLOTS = [
    ("north", 1, [(35.0, 32.005), (35.006, 32.005), (35.006, 32.01), (35.0, 32.01)]),
    ("inner", 2, [(35.002, 32.002), (35.004, 32.0025), (35.0035, 32.0065), (35.0015, 32.006)]),
    ("south", 3, [(35.0, 32.0), (35.005, 32.0), (35.005, 32.004), (35.0, 32.004)]),
]


def plots(spark: SparkSession) -> DataFrame:
    rows = [(name, place, [(float(a), float(b)) for a, b in ring]) for name, place, ring in PLOTS]
    return spark.createDataFrame(rows, "plot string, place int, ring array<struct<lon:double,lat:double>>")
