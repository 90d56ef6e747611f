"""Nested annotation documents, JSON properties, hash splits and sampling."""

from pyspark.sql import functions as F

from ..operators import annotations as A
from .tables import WITH_TRACKS, read, tracks


def _images(s, d):
    return tracks(s, d).select(F.col("scan_id").alias("source"), F.col("frame").alias("id")).distinct().withColumn("file_name", F.concat_ws("_", F.lit("frame"), "source", "id"))


def _annotations(s, d):
    return tracks(s, d).select(F.col("scan_id").alias("source"), F.col("pos").alias("id"), F.col("frame").alias("image_id"), F.col("class").alias("category_id"))


def _merged(s, d):
    _, notes = A.renumbered(_images(s, d), _annotations(s, d), "source")
    return notes.select(F.col("new_id").alias("id"), F.col("new_image").alias("image_id"), "category_id")


def _subset(s, d):
    """Images whose name holds a part, under ids that name their source too."""
    both = lambda df, c: df.withColumn(c, F.col(c) * 10 + F.col("source"))
    kept = A.subset(both(_images(s, d), "id"), both(_annotations(s, d), "image_id"), F.col("file_name").contains("_1_1"))[1]
    return kept.withColumn("image_id", F.expr("image_id div 10"))


_IMAGES = f"{WITH_TRACKS}, images AS (SELECT DISTINCT scan_id AS source, frame AS id FROM tracks), notes AS (SELECT scan_id AS source, pos AS id, frame AS image_id, class AS category_id FROM tracks)"
_PART = "('0x' || substr(md5('42:' || id), 1, 8))::BIGINT % 100 < 80"

QUERIES = {
    "json_props": (
        lambda s, d: read(s, d, "events").select("event_id", F.from_json("props", "k int").getField("k").alias("k")).where("k is not null").groupBy("k").agg(F.count("*").alias("n")),
        "SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS k, count(*) AS n FROM events WHERE json_extract(props, '$.k') IS NOT NULL GROUP BY ALL",
    ),
    "coco_explode": (
        lambda s, d: A.exploded(A.nested(_images(s, d), _annotations(s, d).drop("file_name"), ["source"]), "annotations").select("id", "image_id", "category_id"),
        f"{_IMAGES} SELECT id, image_id, category_id FROM notes",
    ),
    "coco_merge_renumber": (
        _merged,
        f"""{_IMAGES}, i AS (SELECT source, id, row_number() OVER (ORDER BY source, id) AS new_id FROM images)
        SELECT row_number() OVER (ORDER BY n.source, n.id, category_id, i.new_id) AS id, i.new_id AS image_id, category_id FROM notes n JOIN i ON i.source = n.source AND i.id = n.image_id""",
    ),
    "coco_subset": (
        lambda s, d: _subset(s, d).groupBy("source", "image_id").agg(F.count("*").alias("n")),
        f"{_IMAGES} SELECT source, image_id, count(*) AS n FROM notes WHERE (source, image_id) IN (SELECT source, id FROM images WHERE contains('frame_' || source || '_' || id, '_1_1')) GROUP BY ALL",
    ),
    "coco_recat": (
        lambda s, d: A.relabelled(_annotations(s, d), {0: 1, 1: 0}).groupBy("category_id").agg(F.count("*").alias("n")),
        f"{_IMAGES} SELECT CAST(1 - category_id AS BIGINT) AS category_id, count(*) AS n FROM notes WHERE category_id < 2 GROUP BY ALL",
    ),
    "coco_clean": (
        lambda s, d: A.cleaned(tracks(s, d).select("pos", (F.col("x1") - 100.0).alias("x"), (F.col("y1") - 50.0).alias("y"), (F.col("x2") - F.col("x1")).cast("double").alias("w"), (F.col("y2") - F.col("y1")).cast("double").alias("h"), (F.col("class") % 2).alias("iscrowd")), F.lit(1000.0), F.lit(1200.0), 0.5).select("pos", "x1", "y1", "x2", "y2"),
        f"""{WITH_TRACKS}, r AS (SELECT pos, greatest(0, x1 - 100.0::DOUBLE) AS a, greatest(0, y1 - 50.0::DOUBLE) AS b, x2 - x1 AS w, y2 - y1 AS h FROM tracks WHERE class % 2 = 0),
        q AS (SELECT pos, a, b, least(999.0::DOUBLE, a + w) AS c, least(1199.0::DOUBLE, b + h) AS e FROM r) SELECT pos, a * 0.5::DOUBLE AS x1, b * 0.5::DOUBLE AS y1, c * 0.5::DOUBLE AS x2, e * 0.5::DOUBLE AS y2 FROM q WHERE c >= a AND e >= b""",
    ),
    "hash_split": (
        lambda s, d: _annotations(s, d).select("id", A.in_first_part("id", 80).alias("train")),
        f"{_IMAGES} SELECT id, {_PART} AS train FROM notes",
    ),
    "coco_to_mot": (
        lambda s, d: tracks(s, d).select("pos", F.expr("cast(element_at(split(concat_ws('_', 'frame', scan_id, frame), '_'), -1) as int)").alias("frame"), F.col("track_id").alias("id"), F.col("x1").alias("x"), F.col("y1").alias("y"), (F.col("x2") - F.col("x1")).alias("w"), (F.col("y2") - F.col("y1")).alias("h")),
        f"{WITH_TRACKS} SELECT pos, CAST(frame AS INTEGER) AS frame, track_id AS id, x1 AS x, y1 AS y, x2 - x1 AS w, y2 - y1 AS h FROM tracks",
    ),
    "path_keys": (
        lambda s, d: read(s, d, "customer").select("c_custkey", F.concat_ws("/", F.lit("plots"), F.concat(F.lit("row_"), F.col("c_nationkey")), "c_custkey").alias("path")).select("c_custkey", F.regexp_extract("path", r"row_(\d+)", 1).cast("int").alias("row"), F.element_at(F.split("path", "/"), -1).alias("last"), F.lpad(F.element_at(F.split("path", "/"), -1), 6, "0").alias("padded")),
        "SELECT c_custkey, CAST(c_nationkey AS INTEGER) AS row, CAST(c_custkey AS VARCHAR) AS last, lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS padded FROM customer",
    ),
}
