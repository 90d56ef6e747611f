"""Column arithmetic on boxes: formats, scales, clips, filters, sensor remaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def letterbox(det: tuple[int, int], frame: tuple[int, int]) -> float:
    """The factor from detector pixels back to frame pixels."""
    return 1 / min(det[0] / frame[0], det[1] / frame[1])


def scaled(column: str, factor: float) -> Column:
    """Truncated toward zero."""
    return (F.col(column) * F.lit(float(factor))).cast("int")


def clipped(column: Column, high: float) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(high), column))


def xyxy_to_xywh(t: str = "") -> list[Column]:
    c = lambda n: F.col(f"{t}{n}")
    return [c("x1").alias("x"), c("y1").alias("y"), (c("x2") - c("x1")).alias("w"), (c("y2") - c("y1")).alias("h")]


def xywh_to_xyxy() -> list[Column]:
    return [F.col("x").alias("x1"), F.col("y").alias("y1"), (F.col("x") + F.col("w")).alias("x2"), (F.col("y") + F.col("h")).alias("y2")]


def centred() -> list[Column]:
    """cx, cy, aspect and height."""
    w, h = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    return [(F.col("x1") + w / 2).alias("cx"), (F.col("y1") + h / 2).alias("cy"), F.try_divide(w, h).alias("aspect"), h.alias("h")]


def shrunk(share: float) -> list[Column]:
    """The middle of a box, with `share` of its width and height."""
    mx, my = (F.col("x2") - F.col("x1")) * (1 - share) / 2, (F.col("y2") - F.col("y1")) * (1 - share) / 2
    return [(F.col("x1") + mx).alias("x1"), (F.col("y1") + my).alias("y1"), (F.col("x2") - mx).alias("x2"), (F.col("y2") - my).alias("y2")]


def transformed(boxes: DataFrame, det: tuple[int, int], frame: tuple[int, int]) -> DataFrame:
    """A table of the projections at once: scaled, sized, centred and clipped."""
    k = letterbox(det, frame)
    w, h = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    return boxes.select(
        "pos",
        *(scaled(c, k).alias(f"s{c}") for c in ("x1", "y1", "x2", "y2")),
        w.alias("w"),
        h.alias("h"),
        ((F.col("x1") + F.col("x2")) / 2).alias("cx"),
        ((F.col("y1") + F.col("y2")) / 2).alias("cy"),
        (w * h).alias("area"),
        F.round(w / h, 6).alias("aspect"),
        *(clipped(F.col(c) + 10, 1400).alias(f"c{c}") for c in ("x1", "x2")),
    )


def filtered(boxes: DataFrame, least_area: float, least_score: float, low: float, high: float) -> DataFrame:
    """Boxes over an area, at least as sure as a score, and between two squares in size."""
    size = (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))
    return boxes.where((size > least_area) & (F.col("score") >= least_score) & (size > low * low) & (size < high * high))


def slice_boxes(slices: DataFrame, width: int, height: int) -> DataFrame:
    """Slices as (x, y, w, h); rows of the last tree that begin at 0 are artefacts and go."""
    start = F.when(F.col("start") == -1, F.lit(0)).otherwise(F.col("start")).cast("long")
    end = F.when(F.col("end") == -1, F.lit(width - 1)).otherwise(F.col("end")).cast("long")
    last = slices.agg(F.max("tree_id").alias("__last"))
    rows = slices.join(F.broadcast(last)).withColumns({"x": start, "w": end - start})
    return rows.where(~((F.col("tree_id") == F.col("__last")) & (F.col("x") == 0))).select(*(c for c in slices.columns if c not in ("start", "end")), "x", F.lit(0).alias("y"), "w", F.lit(height).alias("h"))


def rescaled_bound(column: str, ratio: float, floor: bool = False) -> Column:
    """A bound over a ratio; -1 stays -1."""
    value = F.floor(F.col(column) / ratio) if floor else F.col(column) / ratio
    return F.when(F.col(column) == -1, F.lit(-1)).otherwise(value)


def to_other_sensor(point: Column, x1: Column, x2: Column, width: int, edge: int = 10) -> Column:
    """A point of one sensor in the pixels of another that sees x1 to x2 of it; points outside go near the edge."""
    return F.when(point <= x1, F.lit(float(edge))).when(point >= x2, F.lit(float(width - edge))).otherwise((point - x1) * width / (x2 - x1))


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0."""
    return F.try_divide(a, b)


def fused_score() -> Column:
    """How sure a detection is: of an object, times of its class."""
    return F.col("obj_conf") * F.col("class_conf")


def window_of(tx: Column, ty: Column, roi: tuple[int, int], origin: tuple[int, int, int, int], size: tuple[int, int]) -> list[Column]:
    """x1, y1, x2, y2 of a region of a given size moved by (tx, ty) and kept within the image; rows are moved from the origin's top."""
    left = F.when(tx < 0, F.lit(0)).when(tx + roi[0] > size[0], F.lit(size[0] - roi[0])).otherwise(tx)
    right = F.when(tx < 0, F.lit(roi[0])).when(tx + roi[0] > size[0], F.lit(size[0])).otherwise(tx + roi[0])
    top = F.when(ty < 0, F.when(ty + origin[1] < 0, F.lit(origin[1])).otherwise(ty + origin[1])).when(ty + roi[1] > size[1], F.lit(origin[3] - roi[1])).otherwise(ty + origin[1])
    bottom = F.when((ty >= 0) & (ty + roi[1] > size[1]), F.lit(origin[3])).otherwise(top + roi[1])
    return [left.alias("x1"), top.alias("y1"), right.alias("x2"), bottom.alias("y2")]


def affine_parts(m: str) -> list[Column]:
    """tx, ty (rounded half to even) and sx, sy of a 2 x 3 matrix as an array of six; all null where a shift is null or NaN."""
    at = lambda k: F.get(F.col(m), F.lit(k))
    ok = at(2).isNotNull() & at(5).isNotNull() & ~F.isnan(at(2)) & ~F.isnan(at(5))
    length = lambda a, b: F.sqrt(at(a) * at(a) + at(b) * at(b))
    parts = {"tx": F.bround(at(2)).cast("long"), "ty": F.bround(at(5)).cast("long"), "sx": length(0, 1), "sy": length(3, 4)}
    return [F.when(ok, c).alias(n) for n, c in parts.items()]


def placed_coordinates(tx: Column, ty: Column, sx: Column, sy: Column, width: int, height: int, whole: tuple[int, int]) -> list[Column]:
    """Where a `width` x `height` image that is moved and scaled lies in another; all of that other (`whole`) where a part is null."""
    known = tx.isNotNull() & ty.isNotNull() & sx.isNotNull() & sy.isNotNull()
    found = {"x1": tx, "y1": ty, "x2": tx + sx * width, "y2": ty + sy * height}
    other = {"x1": 0, "y1": 0, "x2": whole[0] - 1, "y2": whole[1] - 1}
    return [F.when(known, c.cast("double")).otherwise(F.lit(float(other[n]))).alias(n) for n, c in found.items()]


def range_class(size: Column, close_scene: Column, far: float = 250, mid: float = 400) -> Column:
    """far, mid or close by a box's size in a close scene; mid in any other."""
    return F.when(close_scene, F.when(size < far, "far").when(size < mid, "mid").otherwise("close")).otherwise("mid")


def ripeness(mode: Column, median: Column, mean: Column) -> Column:
    """1 to 5 by the mode of the hue; between 17.5 and 45 a mean well above the median is 3, else 4; 0 without pixels."""
    middle = F.when(median * 1.15 > mean, 4).otherwise(3)
    return F.when(mode.isNull(), 0).when(mode < 10, 1).when(mode < 17.5, 2).when(mode < 45, middle).otherwise(5)


def affine_boxes(scale: float, pad_x: float, pad_y: float, width: float, height: float) -> list[Column]:
    """Boxes scaled, padded and kept within an image."""
    return [clipped(F.col(c) * scale + pad, most).alias(c) for c, pad, most in (("x1", pad_x, width), ("y1", pad_y, height), ("x2", pad_x, width), ("y2", pad_y, height))]


def centre_to_corners() -> list[Column]:
    """x1, y1, x2, y2 of (cx, cy, aspect, h)."""
    w, h = F.col("aspect") * F.col("h"), F.col("h")
    return [(F.col("cx") - w / 2).alias("x1"), (F.col("cy") - h / 2).alias("y1"), (F.col("cx") + w / 2).alias("x2"), (F.col("cy") + h / 2).alias("y2")]


def zoomed(factor: float, left: float, top: float, width: float, height: float) -> list[Column]:
    """Boxes after cutting a window at (left, top) out of an image, 1 / factor of its size, and enlarging it to the whole image; parts outside are cut off."""
    return [clipped((F.col(c) - low) * factor, most).alias(c) for c, low, most in (("x1", left, width), ("y1", top, height), ("x2", left, width), ("y2", top, height))]
