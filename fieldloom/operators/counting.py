"""Fruit counts: tracks cut by tree slices, counted under sighting and depth filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

OPEN = -1


def close_bounds(slices: DataFrame, last: int) -> DataFrame:
    """Open starts become 0 and open ends `last`."""
    return slices.withColumns({"start": F.when(F.col("start") == OPEN, 0).otherwise(F.col("start")), "end": F.when(F.col("end") == OPEN, last).otherwise(F.col("end"))})


def densify(slices: DataFrame, by: list[str]) -> DataFrame:
    """A row for every frame from a tree's first to its last; frames that were missing get open bounds."""
    span = slices.groupBy(*by, "tree_id").agg(F.min("frame").alias("lo"), F.max("frame").alias("hi"))
    frames = span.select(*by, "tree_id", F.explode(F.sequence("lo", "hi")).alias("frame"))
    known = slices.select(*by, "tree_id", "frame", "start", "end")
    return frames.join(known, [*by, "tree_id", "frame"], "left").select(*by, "tree_id", "frame", *(F.coalesce(c, F.lit(OPEN)).alias(c) for c in ("start", "end")))


def contained(tracks: DataFrame, slices: DataFrame, by: list[str]) -> DataFrame:
    """Boxes strictly inside a slice of their frame: x1 > start and x2 < end."""
    return tracks.join(slices.select(*by, "frame", "tree_id", "start", "end"), [*by, "frame"]).where("x1 > start and x2 < end")


def overlapping(tracks: DataFrame, slices: DataFrame, by: list[str]) -> DataFrame:
    """Boxes that meet a slice of their frame; an open bound does not cut."""
    return tracks.join(slices.select(*by, "frame", "tree_id", "start", "end"), [*by, "frame"]).where(f"(start = {OPEN} or start < x2) and (end = {OPEN} or end > x1)")


def tree_counts(tracks: DataFrame, slices: DataFrame, by: list[str], last: int = 1535, sightings: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """cv<k>: distinct tracks of a tree with at least k boxes inside its slices; trees without any keep a zero."""
    closed = close_bounds(densify(slices, by), last)
    key = [*by, "tree_id"]
    seen = contained(tracks, closed, by).groupBy(*key, "track_id").agg(F.count("*").alias("n"))
    counts = seen.groupBy(*key).agg(*(F.sum((F.col("n") >= k).cast("long")).alias(f"cv{k}") for k in sightings))
    return slices.select(*key).distinct().join(counts, key, "left").select(*key, *(F.coalesce(f"cv{k}", F.lit(0)).cast("long").alias(f"cv{k}") for k in sightings))


def tree_counts_overlap(tracks: DataFrame, slices: DataFrame, by: list[str]) -> DataFrame:
    """Distinct tracks that meet a tree's slices."""
    key = [*by, "tree_id"]
    return overlapping(tracks, slices, by).groupBy(*key).agg(F.countDistinct("track_id").alias("cv"))


def within_depth(most: float, mode: str = "below") -> Column:
    """`below`: depth < most, so that nulls and NaN go; `drop_above`: only depth > most goes."""
    depth = F.col("depth")
    if mode == "below":
        return (depth < most) & ~F.isnan(depth)
    return depth.isNull() | F.isnan(depth) | (depth <= most)


def row_counts(tracks: DataFrame, by: list[str], most_depth: float, least: int) -> DataFrame:
    """Distinct tracks of a row under no filter, depth, sightings, and both; sightings are counted over the whole row."""
    per = tracks.groupBy(*by, "track_id").agg(F.count("*").alias("n"), F.max(F.coalesce(within_depth(most_depth), F.lit(False))).alias("near"))
    return per.groupBy(*by).agg(
        F.count("*").alias("n_all"),
        F.sum(F.col("near").cast("long")).alias("n_depth"),
        F.sum((F.col("n") >= least).cast("long")).alias("n_seen"),
        F.sum((F.col("near") & (F.col("n") >= least)).cast("long")).alias("n_both"),
    )


def sighting_counts(tracks: DataFrame, by: list[str], most_depth: float) -> DataFrame:
    """Tracks seen once, over once, over twice ...; boxes; and frames of the row without any box."""
    kept = tracks.where(within_depth(most_depth, "drop_above"))
    per = kept.groupBy(*by, "track_id").agg(F.count("*").alias("n"))
    over = per.groupBy(*by).agg(F.count("*").alias("n"), *(F.sum((F.col("n") > k).cast("long")).alias(f"over{k}") for k in range(1, 5)))
    boxes = kept.groupBy(*by).agg(F.count("*").alias("n_dets"), (F.max("frame") + 1 - F.countDistinct("frame")).cast("long").alias("n_dropped"))
    return over.join(boxes, by)


def depth_counts(tracks: DataFrame, by: list[str], most_depth: float, steps: int = 5) -> DataFrame:
    """dcv<i>: tracks with more than i - 1 boxes no deeper than `most_depth`."""
    per = tracks.where(F.col("depth") <= most_depth).groupBy(*by, "track_id").agg(F.count("*").alias("n"))
    return per.groupBy(*by).agg(*(F.sum((F.col("n") > i).cast("long")).alias(f"dcv{i + 1}") for i in range(steps)))


def dense_ids(tracks: DataFrame, by: list[str]) -> DataFrame:
    """Track ids renumbered from 0 in their order. Ids are made distinct first, so that the window holds one row for each track."""
    ids = tracks.select(*by, "track_id").distinct()
    return ids.select(*by, "track_id", (F.row_number().over(Window.partitionBy(*by).orderBy("track_id")) - 1).cast("long").alias("new_id"))


def new_per_frame(tracks: DataFrame, by: list[str]) -> DataFrame:
    """Tracks that appear for the first time in each frame; frames without any keep a zero."""
    first = tracks.groupBy(*by, "track_id").agg(F.min("frame").alias("frame")).groupBy(*by, "frame").agg(F.count("*").alias("n"))
    return tracks.select(*by, "frame").distinct().join(first, [*by, "frame"], "left").select(*by, "frame", F.coalesce("n", F.lit(0)).cast("long").alias("n_new"))


def merged_counts(parts: list[DataFrame], by: list[str], value: str) -> DataFrame:
    """Counts of several files summed by key."""
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p, allowMissingColumns=True)
    return whole.groupBy(*by).agg(F.sum(value).alias(value))


def tree_filter_counts(tracks: DataFrame, slices: DataFrame, by: list[str], most_depth: float, least: int, last: int = 1535) -> DataFrame:
    """Distinct tracks of each tree under no filter, depth, sightings, and both. Sightings are counted within the tree, before the depth filter."""
    key = [*by, "tree_id"]
    seen = contained(tracks, close_bounds(densify(slices, by), last), by)
    per = seen.groupBy(*key, "track_id").agg(F.count("*").alias("n"), F.max(F.coalesce(within_depth(most_depth), F.lit(False))).alias("near"))
    often = F.col("n") >= least
    wanted = {"n_all": F.lit(True), "n_depth": F.col("near"), "n_seen": often, "n_both": F.col("near") & often}
    counts = per.groupBy(*key).agg(*(F.sum(c.cast("long")).alias(n) for n, c in wanted.items()))
    return slices.select(*key).distinct().join(counts, key, "left").select(*key, *(F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in wanted))


def new_per_interval(tracks: DataFrame, by: list[str], every: int) -> DataFrame:
    """Tracks first seen at each `every`-th frame that a scan has, by place; frames between are not looked at."""
    frames = tracks.select(*by, "frame").distinct().withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy("frame")) - 1)
    return new_per_frame(tracks.join(frames.where(F.col("__n") % every == 0).select(*by, "frame"), [*by, "frame"], "left_semi"), by)


def appearance_ids(rows: DataFrame, by: list[str], ident: str, order: list[str]) -> DataFrame:
    """Ids renumbered from 0 in the order in which they first appear."""
    first = rows.groupBy(*by, ident).agg(F.min(F.struct(*order)).alias("__first"))
    return first.select(*by, ident, (F.row_number().over(Window.partitionBy(*by).orderBy("__first", ident)) - 1).cast("long").alias("new_id"))


def frame_spans(rows: DataFrame, by: list[str]) -> DataFrame:
    """First and last frame of each group."""
    return rows.groupBy(*by).agg(F.min("frame").alias("first_frame"), F.max("frame").alias("last_frame"))


def every_kth(rows: DataFrame, by: list[str], order: str, k: int) -> DataFrame:
    """Every k-th row of a group by place, from the first."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy(order)) - 1).where(F.col("__n") % k == 0).drop("__n")
