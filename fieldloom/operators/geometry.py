"""Points in polygons, boxes, overlaps, suppression and matching of boxes within a frame."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .grouped import fold_groups, near_pairs, numbers


def in_ring(lat: Column, lon: Column, ring: Column) -> Column:
    """Ray casting over a ring of (lon, lat) whose last point is joined to its first; points on an edge may fall either way."""
    n = F.size(ring)

    def crosses(k: Column) -> Column:
        a, b = F.get(ring, k), F.get(ring, (k + 1) % n)
        across = (a["lat"] > lat) != (b["lat"] > lat)
        at = (b["lon"] - a["lon"]) * (lat - a["lat"]) / F.nullif(b["lat"] - a["lat"], F.lit(0.0)) + a["lon"]
        return across & (lon < at)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(False), lambda inside, k: F.when(crosses(k), ~inside).otherwise(inside))


def edge_distance(lat: Column, lon: Column, ring: Column) -> Column:
    """The distance of a point from the nearest edge of a ring, in the ring's own units."""
    n = F.size(ring)

    def to_edge(k: Column) -> Column:
        a, b = F.get(ring, k), F.get(ring, (k + 1) % n)
        dx, dy = b["lon"] - a["lon"], b["lat"] - a["lat"]
        along = F.coalesce(F.try_divide((lon - a["lon"]) * dx + (lat - a["lat"]) * dy, dx * dx + dy * dy), F.lit(0.0))
        t = F.least(F.greatest(along, F.lit(0.0)), F.lit(1.0))
        x, y = lon - a["lon"] - t * dx, lat - a["lat"] - t * dy
        return F.sqrt(x * x + y * y)

    return F.array_min(F.transform(F.sequence(F.lit(0), n - 1), to_edge))


def in_inset(lat: Column, lon: Column, ring: Column, margin: float) -> Column:
    """Whether a point lies in a ring and no nearer to its edges than a margin; what a notch cuts off stays a part of it. Points without coordinates do not."""
    inside = in_ring(lat, lon, ring) & (edge_distance(lat, lon, ring) >= margin)
    return F.coalesce(F.when(F.size(ring) > 0, inside), F.lit(False))


def intersection(a: str, b: str, inclusive: bool) -> Column:
    """Common area of two boxes; inclusive counts both edge pixels."""
    more = 1 if inclusive else 0
    c = lambda t, n: F.col(f"{t}.{n}" if t else n).cast("double")
    w = F.least(c(a, "x2"), c(b, "x2")) - F.greatest(c(a, "x1"), c(b, "x1")) + more
    h = F.least(c(a, "y2"), c(b, "y2")) - F.greatest(c(a, "y1"), c(b, "y1")) + more
    return F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))


def area(t: str, inclusive: bool = False) -> Column:
    more = 1 if inclusive else 0
    c = lambda n: F.col(f"{t}.{n}").cast("double")
    return (c("x2") - c("x1") + more) * (c("y2") - c("y1") + more)


def iou(a: str, b: str, inclusive_common: bool, inclusive_area: bool) -> Column:
    common = intersection(a, b, inclusive_common)
    return F.try_divide(common, area(a, inclusive_area) + area(b, inclusive_area) - common)


def frame_pairs(boxes: DataFrame, by: list[str], condition: Column) -> DataFrame:
    """Pairs (a, b) of boxes of one frame that meet, a before b by `pos`, under a condition on them. Only boxes that share a cell of 128 pixels are compared, and each pair in the first cell of both."""
    cell = 128
    packed = boxes.select(*by, F.struct(*boxes.columns).alias("box"))
    cells = packed.select(
        *by, "box", F.explode(F.sequence(F.floor(F.col("box.x1") / cell), F.floor(F.col("box.x2") / cell))).alias("cx"), F.sequence(F.floor(F.col("box.y1") / cell), F.floor(F.col("box.y2") / cell)).alias("ys")
    ).select(*by, "box", "cx", F.explode("ys").alias("cy"))
    a, b = cells.withColumnRenamed("box", "a"), cells.withColumnRenamed("box", "b")
    both = a.join(b, [*by, "cx", "cy"]).where("a.pos < b.pos")
    both = both.where((F.col("cx") == F.floor(F.greatest("a.x1", "b.x1") / cell)) & (F.col("cy") == F.floor(F.greatest("a.y1", "b.y1") / cell)))
    return both.where(condition).select(*by, "a", "b")


def without_duplicates(boxes: DataFrame, by: list[str], most: float) -> DataFrame:
    """Boxes that no earlier box of their frame overlaps by over `most`; boxes that go still drive out others."""
    pairs = frame_pairs(boxes, by, iou("a", "b", True, False) > most)
    return boxes.join(pairs.select(*by, "b.pos").distinct(), [*by, "pos"], "left_anti")


def without_covering(boxes: DataFrame, by: list[str], most: float) -> DataFrame:
    """Boxes of which no other box of the frame is covered by over `most` of its area."""
    pairs = frame_pairs(boxes, by, intersection("a", "b", True) > 0)
    common = intersection("a", "b", True)
    gone = pairs.where(common > most * area("b")).select(*by, "a.pos").union(pairs.where(common > most * area("a")).select(*by, "b.pos"))
    return boxes.join(gone.distinct(), [*by, "pos"], "left_anti")


def best_overlaps(truth: DataFrame, found: DataFrame, by: list[str]) -> DataFrame:
    """The best overlap of each true box with the found boxes of its frame; 0 where there is none."""
    pairs = cross_pairs(truth, found, by).groupBy(*by, F.col("a.pos").alias("pos")).agg(F.max(iou("a", "b", True, False)).alias("best"))
    return truth.select(*by, "pos").join(pairs, [*by, "pos"], "left").select(*by, "pos", F.coalesce("best", F.lit(0.0)).alias("best"))


def greedy_pairs(score: np.ndarray) -> list[tuple[int, int]]:
    """(row, column) pairs by falling score, ties by row then column, each used once, down to scores above 0."""
    out, rows, columns = [], set(), set()
    r, c = np.nonzero(score > 0)
    order = np.argsort(-score[r, c], kind="stable")
    for r, c in zip(r[order].tolist(), c[order].tolist()):
        if r not in rows and c not in columns:
            out.append((r, c))
            rows.add(r)
            columns.add(c)
    return out


def greedy_assign(scores: DataFrame, by: list[str]) -> DataFrame:
    """(by, trk, det, score) chosen greedily within each frame from (by, trk, det, score), by falling score, ties by trk then det, down to scores above 0.

    A frame's scores are put in order where they are gathered; a call takes many frames.
    """
    kinds = dict(scores.dtypes)
    option = F.struct((-F.col("score")).alias("less"), F.col("trk").cast("long").alias("trk"), F.col("det").cast("long").alias("det"))
    frames = scores.where("score > 0").groupBy(*by).agg(F.array_sort(F.collect_list(option)).alias("options"))

    def run(parts):
        for pdf in parts:
            picked = []
            for options in pdf["options"]:
                rows, columns, own = set(), set(), []
                for o in options:
                    if o["trk"] not in rows and o["det"] not in columns:
                        own.append({"trk": o["trk"], "det": o["det"], "score": -o["less"]})
                        rows.add(o["trk"])
                        columns.add(o["det"])
                picked.append(own)
            yield pdf[by].assign(picked=picked)

    out = frames.mapInPandas(run, ", ".join(f"{c} {kinds[c]}" for c in by) + ", picked array<struct<trk:bigint,det:bigint,score:double>>")
    return out.select(*by, F.inline("picked"))


def non_maximum_suppression(boxes: DataFrame, by: list[str], most: float) -> DataFrame:
    """Boxes left when, by falling score (then pos), each drives out the later ones that it overlaps by over `most`.

    A call takes many groups. In a round, a box stays if no earlier rival of it is left, and drives out its later ones, so that rounds follow the longest chain.
    """

    def fold(table, groups):
        x1, y1, x2, y2 = (numbers(table, c).astype(float) for c in ("x1", "y1", "x2", "y2"))
        size = (x2 - x1) * (y2 - y1)

        def over(i, j):
            common = np.clip(np.minimum(x2[i], x2[j]) - np.maximum(x1[i], x1[j]), 0, None) * np.clip(np.minimum(y2[i], y2[j]) - np.maximum(y1[i], y1[j]), 0, None)
            return common > most * (size[i] + size[j] - common)

        order = np.lexsort((numbers(table, "pos"), -numbers(table, "score").astype(float), groups))
        place = np.empty(len(order), int)
        place[order] = np.arange(len(order))
        i, j = near_pairs(groups, x1, x2, over)
        first, later = np.minimum(place[i], place[j]), np.maximum(place[i], place[j])
        kept, undecided = np.zeros(len(order), bool), np.ones(len(order), bool)
        while undecided.any():
            blocked = np.zeros(len(order), bool)
            blocked[later] = True
            now = undecided & ~blocked
            kept |= now
            undecided &= ~now
            gone = np.zeros(len(order), bool)
            gone[later[now[first]]] = True
            undecided &= ~gone
            open_ = undecided[first] & undecided[later]
            first, later = first[open_], later[open_]
        return table.take(order[kept])

    return fold_groups(boxes, by, fold, boxes.schema)


def cross_pairs(left: DataFrame, right: DataFrame, by: list[str], cell: int = 128) -> DataFrame:
    """Pairs (by, a, b) of a left and a right box of one frame that touch; each meets in one cell only, so that far boxes are never paired."""

    def cells(boxes: DataFrame, name: str) -> DataFrame:
        span = lambda lo, hi: F.sequence(F.floor(F.col(f"{name}.{lo}") / cell), F.floor(F.col(f"{name}.{hi}") / cell))
        packed = boxes.select(*by, F.struct(*boxes.columns).alias(name))
        return packed.select(*by, name, F.explode(span("x1", "x2")).alias("cx"), span("y1", "y2").alias("ys")).select(*by, name, "cx", F.explode("ys").alias("cy"))

    both = cells(left, "a").join(cells(right, "b"), [*by, "cx", "cy"])
    first = (F.col("cx") == F.floor(F.greatest("a.x1", "b.x1") / cell)) & (F.col("cy") == F.floor(F.greatest("a.y1", "b.y1") / cell))
    return both.where(first).select(*by, "a", "b")


def destination(lat: Column, lon: Column, bearing: float, metres: float, radius: float = 6_371_000.0) -> list[Column]:
    """lat, lon of the point that lies `metres` from another in a direction in degrees."""
    d, b = metres / radius, F.radians(F.lit(float(bearing)))
    p, q = F.radians(lat), F.radians(lon)
    to = F.asin(F.sin(p) * F.cos(F.lit(d)) + F.cos(p) * F.sin(F.lit(d)) * F.cos(b))
    along = q + F.atan2(F.sin(b) * F.sin(F.lit(d)) * F.cos(p), F.cos(F.lit(d)) - F.sin(p) * F.sin(to))
    return [F.degrees(to).alias("to_lat"), F.degrees(along).alias("to_lon")]
