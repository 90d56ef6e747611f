"""Relational algebra over nested annotation documents: explode, nest, merge with new ids, subset, relabel, split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scans import PART, in_ranges, running_sums


def exploded(documents: DataFrame, part: str) -> DataFrame:
    """The rows of one array of each document (images, annotations or categories)."""
    return documents.selectExpr(f"inline({part})")


def nested(images: DataFrame, annotations: DataFrame, by: list[str]) -> DataFrame:
    """One document for each group, its parts sorted by id."""
    pack = lambda df, name: df.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(*(c for c in df.columns if c not in by)))).alias(name))
    return pack(images, "images").join(pack(annotations, "annotations"), by, "left")


def renumbered(images: DataFrame, annotations: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """Images and annotations of several sources under new ids from 1, in order of source and old id, with image_id rewritten; annotations without an image go.

    Rows are numbered in ranges of about equal size, so that neither all rows nor those of one source have to fit into a task.
    """
    image_map = _numbered(images, source).withColumnRenamed("id", "old_image")
    new_images = image_map.select("new_id", *(c for c in images.columns if c not in ("id",)))
    linked = annotations.join(image_map.select(source, F.col("old_image").alias("image_id"), F.col("new_id").alias("new_image")), [source, "image_id"])
    return new_images, _numbered(linked.drop("image_id"), source).drop("id")


def _numbered(rows: DataFrame, source: str) -> DataFrame:
    order = [source, "id", *(c for c in rows.columns if c not in (source, "id"))]
    ranged = in_ranges(rows.where(F.col(source).isNotNull()), [], order)
    return running_sums(ranged, [], order, {"new_id": F.lit(1)}).withColumn("new_id", F.col("new_id").cast("long")).drop(PART)


def subset(images: DataFrame, annotations: DataFrame, wanted: Column) -> tuple[DataFrame, DataFrame]:
    """The images for which a condition holds, with their annotations."""
    kept = images.where(wanted)
    return kept, annotations.join(kept.select(F.col("id").alias("image_id")), "image_id", "left_semi")


def relabelled(annotations: DataFrame, mapping: dict[int, int], other: int | None = None) -> DataFrame:
    """Category ids by a table; those not named become `other`, or go where it is None."""
    new = F.col("category_id")
    chain = F.when(F.lit(False), F.lit(0))
    for a, b in mapping.items():
        chain = chain.when(new == a, F.lit(b))
    out = annotations.withColumn("category_id", chain.otherwise(F.lit(other)).cast("long"))
    return out.where("category_id is not null")


def in_first_part(key: str, percent: int, seed: int = 42) -> Column:
    """A split that depends on the key alone: md5 of seed and key, mod 100, under `percent`."""
    digest = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), 1, 8), 16, 10).cast("long")
    return digest % 100 < percent


def class_stats(annotations: DataFrame) -> DataFrame:
    """For each category: boxes, images, boxes of an image on average (half to even) and at most."""
    per = annotations.groupBy("category_id", "image_id").agg(F.count("*").alias("n"))
    return per.groupBy("category_id").agg(F.sum("n").alias("boxes"), F.count("*").alias("images"), F.bround(F.avg("n"), 0).cast("long").alias("avg_boxes"), F.max("n").alias("max_boxes"))


def cleaned(annotations: DataFrame, width: Column, height: Column, scale: float = 1.0) -> DataFrame:
    """Boxes (x, y, w, h) clipped to the image and scaled; crowds and boxes without area go."""
    x1, y1 = F.greatest(F.lit(0.0), F.col("x")), F.greatest(F.lit(0.0), F.col("y"))
    x2 = F.least(width - 1, x1 + F.greatest(F.lit(0.0), F.col("w")))
    y2 = F.least(height - 1, y1 + F.greatest(F.lit(0.0), F.col("h")))
    out = annotations.where("iscrowd = 0 and w * h > 0").withColumns({"x1": x1, "y1": y1, "x2": x2, "y2": y2}).where("x2 >= x1 and y2 >= y1")
    return out.withColumns({c: F.col(c) * scale for c in ("x1", "y1", "x2", "y2")})


def from_tracks(tracks: DataFrame, by: list[str], width: int, height: int, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Images and annotations of tracks: an image for each frame, numbered from 1 in the order of first appearance; every annotation has category 1."""
    first = tracks.groupBy(*by, "frame").agg(F.min(F.struct(*order)).alias("__first"))
    images = first.select(*by, "frame", F.row_number().over(Window.partitionBy(*by).orderBy("__first")).cast("long").alias("id"))
    w, h = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    number = F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1
    notes = tracks.withColumn("__id", number.cast("long")).join(images.withColumnRenamed("id", "image_id"), [*by, "frame"])
    notes = notes.select(*by, F.col("__id").alias("id"), "image_id", F.lit(1).alias("category_id"), F.array("x1", "y1", w, h).alias("bbox"), (w * h).alias("area"), F.lit(0).alias("iscrowd"), "score")
    return images.withColumns({"width": F.lit(width), "height": F.lit(height), "file_name": F.concat(F.concat_ws("_", *by), F.lit("_frame_"), F.col("frame"), F.lit(".jpg"))}), notes


def without_names(images: DataFrame, annotations: DataFrame, parts: list[str], by: list[str]) -> tuple[DataFrame, DataFrame]:
    """The images whose names hold none of the parts, and their annotations, both numbered anew from 1 in order of their ids."""
    kept = images
    for p in parts:
        kept = kept.where(~F.col("file_name").contains(p))
    kept = kept.withColumn("new_id", F.row_number().over(Window.partitionBy(*by).orderBy("id")).cast("long"))
    linked = annotations.join(kept.select(*by, F.col("id").alias("image_id"), F.col("new_id").alias("new_image")), [*by, "image_id"])
    linked = linked.withColumn("new_id", F.row_number().over(Window.partitionBy(*by).orderBy("id")).cast("long"))
    return kept, linked


def coco_rows(detections: DataFrame, factor: float) -> DataFrame:
    """Detections as annotation rows: boxes scaled to the image's pixels as (x, y, w, h), with their area and fused score."""
    c = lambda n: F.col(n) * factor
    w, h = c("x2") - c("x1"), c("y2") - c("y1")
    return detections.select("image_id", (F.col("class_pred") + 1).cast("long").alias("category_id"), F.array(c("x1"), c("y1"), w, h).alias("bbox"), (w * h).alias("area"), F.lit(0).alias("iscrowd"), (F.col("obj_conf") * F.col("class_conf")).alias("score"))
