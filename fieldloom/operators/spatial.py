"""Points in many polygons, and exact nearest neighbours, by cells: every join has an equality, and its work follows what is near."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..shared import written
from .geometry import in_ring
from .grouped import fold_groups, numbers, parted


def _cell(x: Column, side: Column) -> Column:
    return F.floor(x / side)


def _bounds(plots: DataFrame) -> DataFrame:
    of = lambda f, c: f(F.transform("ring", lambda p: p[c]))
    return plots.where(F.size("ring") > 0).select("place", "plot", "ring", of(F.array_min, "lon").alias("x1"), of(F.array_max, "lon").alias("x2"), of(F.array_min, "lat").alias("y1"), of(F.array_max, "lat").alias("y2"))


def cell_side(plots: DataFrame) -> float:
    """A side for which n rings cover some 16 n cells by area and 8 n more by their length, whatever their sizes."""
    w, h = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    area, length = _bounds(plots).agg(F.avg(w * h), F.avg(w + h)).first()
    return max((area or 0.0) ** 0.5 / 4, (length or 0.0) / 8) or 1.0


def covered_cells(plots: DataFrame, side: float) -> tuple[DataFrame, DataFrame]:
    """(place, gx, gy) of the cells that the edges of each ring meet, and of those that lie inside as a whole.

    A cell is an edge cell if an edge comes within a millionth of a side of it; all other cells are in or out as their middle is.
    Each ring's cells are told from its own row, without joins; rings are dealt to a number of tasks of their own, as their cells are far more than their bytes tell.
    """
    tasks = int(plots.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds, slack, s = _bounds(plots).repartition(tasks), side * 1e-6, F.lit(side)
    n = F.size("ring")

    def edge(k: Column) -> Column:
        a, b = F.get("ring", k), F.get("ring", (k + 1) % n)
        return F.struct(*(p[c].alias(f"{i}_{c}") for i, p in (("a", a), ("b", b)) for c in ("lon", "lat")), F.least(a["lon"], b["lon"]).alias("low"), F.greatest(a["lon"], b["lon"]).alias("high"))

    def rows(e: Column) -> Column:
        """First and last row that an edge meets within the column, by the latitudes at both ends of its part there."""
        left, right = F.greatest(e["low"], F.col("gx") * s - slack), F.least(e["high"], (F.col("gx") + 1) * s + slack)
        slope = F.try_divide(e["b_lat"] - e["a_lat"], e["b_lon"] - e["a_lon"])
        at = lambda x: e["a_lat"] + (x - e["a_lon"]) * slope
        least, most = F.least(e["a_lat"], e["b_lat"]), F.greatest(e["a_lat"], e["b_lat"])
        steep = e["high"] - e["low"] <= slack
        bottom = F.when(steep, least).otherwise(F.greatest(F.least(at(left), at(right)), least))
        top = F.when(steep, most).otherwise(F.least(F.greatest(at(left), at(right)), most))
        return F.struct(_cell(bottom - slack, s).alias("first"), _cell(top + slack, s).alias("last"))

    reach = lambda a, b: F.sequence(_cell(F.col(a) - slack, s), _cell(F.col(b) + slack, s))
    edges = bounds.select("place", "ring", F.transform(F.sequence(F.lit(0), n - 1), edge).alias("edges"), reach("x1", "x2").alias("gxs"), reach("y1", "y2").alias("gys"))
    columns = edges.select("place", "ring", "edges", F.explode("gxs").alias("gx"), "gys")
    met = F.filter("edges", lambda e: F.col("gx").between(_cell(e["low"] - slack, s), _cell(e["high"] + slack, s)))
    cells = columns.select("place", "ring", "gx", F.transform(met, rows).alias("met"), "gys").select("place", "ring", "gx", "met", F.explode("gys").alias("gy"))
    on_edge = F.coalesce(F.exists("met", lambda r: F.col("gy").between(r["first"], r["last"])), F.lit(False))
    inside = in_ring((F.col("gy") + 0.5) * s, (F.col("gx") + 0.5) * s, F.col("ring"))
    return cells.where(on_edge).select("place", "gx", "gy"), cells.where(~on_edge & inside).select("place", "gx", "gy")


def ring_cells(plots: DataFrame, side: float) -> DataFrame:
    """(gx, gy, place, plot, ring) of the cells that each ring (plot, place, ring) meets; `ring` is null where the whole cell lies inside."""
    on_edge, inner = covered_cells(plots, side)
    own = _bounds(plots).select("place", "plot", "ring")
    named = on_edge.join(own, "place").select("gx", "gy", "place", "plot", "ring")
    return named.union(inner.join(own, "place").select("gx", "gy", "place", "plot", F.lit(None).cast(plots.schema["ring"].dataType)))


#: Up to so many full cells are broadcast, some 20 MB.
FEW_CELLS = 200_000


def located(points: DataFrame, plots: DataFrame, none: str = "global", side: float | None = None) -> DataFrame:
    """`plot` of each point (lat, lon): the first plot (by `place`, which is unique) whose ring holds it, else `none`; any number of plots.

    Rings are covered by cells; a cell has its plots in order, up to the first that fills it. A point meets one cell, so that every point stays one row, and
    only in edge cells its place is settled by ray casting. Points without coordinates are in no plot.
    """
    side = side or cell_side(plots)
    on_edge, inner = covered_cells(plots, side)
    # Plots after the first that fills a cell are never asked there, so that they and their rings are dropped before anything is gathered.
    full = written(inner.groupBy("gx", "gy").agg(F.min("place").alias("__full")), "full")
    # Files are far smaller than their rows in memory, so that not their size but a count tells what may be broadcast.
    asked = on_edge.join(full.hint("broadcast" if full.count() <= FEW_CELLS else "shuffle_merge"), ["gx", "gy"], "left").where("__full is null or place < __full")
    asked = written(asked.select("gx", "gy", "place", "__full").union(full.select("gx", "gy", F.col("__full").alias("place"), "__full")), "asked")
    own = _bounds(plots).select("place", "plot", "ring")
    named = asked.join(own.hint("shuffle_merge"), "place")
    ring = F.when(F.col("__full").isNull() | (F.col("place") < F.col("__full")), F.col("ring"))
    cells = named.select("gx", "gy", "place", "plot", ring.alias("ring")).groupBy("gx", "gy").agg(F.array_sort(F.collect_list(F.struct("place", "plot", "ring"))).alias("__near"))
    cells = written(cells.select(F.col("gx").alias("__gx"), F.col("gy").alias("__gy"), "__near"), "cells")
    met = points.withColumn("__x", _cell(F.col("lon"), F.lit(side))).withColumn("__y", _cell(F.col("lat"), F.lit(side)))
    # Rings compress so well in files that a broadcast by their size there would be far larger on the driver.
    met = met.join(cells.hint("shuffle_merge"), (F.col("__x") == F.col("__gx")) & (F.col("__y") == F.col("__gy")), "left")
    found = F.filter("__near", lambda p: p["ring"].isNull() | in_ring(F.col("lat"), F.col("lon"), p["ring"]))
    return met.withColumn("plot", F.coalesce(F.get(found, F.lit(0))["plot"], F.lit(none))).drop("__x", "__y", "__gx", "__gy", "__near")


#: Up to so many plots are tried one after another for every point.
FEW_PLOTS = 64


def locate(points: DataFrame, plots: DataFrame, none: str = "global") -> DataFrame:
    """`plot` of each point: the first plot (by `place`) whose ring holds it, else `none`.

    A few plots (plot, place, ring) become one array that is broadcast; of more, each point tries those of its cell.
    """
    if plots.limit(FEW_PLOTS + 1).count() > FEW_PLOTS:
        return located(points, plots, none)
    rings = plots.agg(F.array_sort(F.collect_list(F.struct("place", "plot", "ring"))).alias("__plots"))
    found = F.filter("__plots", lambda p: in_ring(F.col("lat"), F.col("lon"), p["ring"]))
    return points.join(F.broadcast(rings)).withColumn("plot", F.coalesce(F.get(found, F.lit(0))["plot"], F.lit(none))).drop("__plots")


def in_any(points: DataFrame, plots: DataFrame) -> DataFrame:
    """`inside` of each point: whether it lies in any plot."""
    numbered = plots.select(F.lit("in").alias("plot"), "place", "ring")
    found = locate(points, numbered, "out")
    return found.withColumn("inside", F.col("plot") == "in").drop("plot")


#: Distances that a fold holds at once.
_BLOCK = 1 << 19


def _nearest_of(asking: np.ndarray, others: np.ndarray, x: np.ndarray, y: np.ndarray, code: np.ndarray, k: int, edge: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """(row, rank, other, distance) of the k nearest of `others` for each of `asking`, nearer than its `edge`; ties go to the smaller code, and equal codes are one point."""
    parts, size = [], max(1, _BLOCK // max(1, len(others)))
    for begin in range(0, len(asking), size):
        own = asking[begin : begin + size]
        far = np.sqrt((x[own][:, None] - x[others]) * (x[own][:, None] - x[others]) + (y[own][:, None] - y[others]) * (y[own][:, None] - y[others]))
        far[code[own][:, None] == code[others]] = np.inf
        far[np.isnan(far)] = np.inf
        most = np.partition(far, k - 1, axis=1)[:, k - 1] if far.shape[1] > k else np.full(len(own), np.inf)
        near = (far <= most[:, None]) & (far < (np.inf if edge is None else edge[own][:, None]))
        r, c = np.nonzero(near)
        order = np.lexsort((code[others[c]], far[r, c], r))
        r, c = r[order], c[order]
        rank = np.arange(len(r)) - np.searchsorted(r, r) + 1
        kept = rank <= k
        r, c = r[kept], c[kept]
        parts.append((own[r], rank[kept], others[c], far[r, c]))
    return tuple(np.concatenate(p) for p in zip(*parts)) if parts else (np.zeros(0, int),) * 3 + (np.zeros(0),)


def _codes(pos: pa.ChunkedArray) -> np.ndarray:
    return pc.rank(pos.combine_chunks() if isinstance(pos, pa.ChunkedArray) else pos, tiebreaker="dense").to_numpy().astype(np.int64)


def _ranked(table: pa.Table, by: list[str], code: np.ndarray, parts: list[tuple]) -> pa.Table:
    row, rank, other, far = (np.concatenate(p) for p in zip(*parts)) if parts else ((np.zeros(0, int),) * 3 + (np.zeros(0),))
    out = table.select([*by, "pos"]).take(pa.array(row, pa.int64())).append_column("rank", pa.array(rank, pa.int32()))
    return out.append_column("other", table.column("pos").take(pa.array(other, pa.int64()))).append_column("distance", pa.array(far, pa.float64()))


def _runs(groups: np.ndarray) -> list[np.ndarray]:
    return np.split(np.arange(len(groups)), np.flatnonzero(np.diff(groups)) + 1)


def nearest(points: DataFrame, by: list[str], k: int, crowd: int = 64) -> DataFrame:
    """(by, pos, rank, other, distance): the k nearest other points (by, pos, cx, cy) of each, ties by `pos`; fewer where a group has fewer.

    Many small groups are folded in a call after one shuffle; large ones are cut by cells (`_nearest_by_cells`). Points without coordinates are left out.
    """
    known = points.where("pos is not null and cx is not null and cy is not null").select(*by, "pos", F.col("cx").cast("double").alias("cx"), F.col("cy").cast("double").alias("cy"))
    kinds = dict(known.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in (*by, "pos")) + f", rank int, other {kinds['pos']}, distance double"
    small, large = parted(known, by)

    def fold(table: pa.Table, groups: np.ndarray) -> pa.Table:
        x, y, code = numbers(table, "cx"), numbers(table, "cy"), _codes(table.column("pos"))
        return _ranked(table, by, code, [_nearest_of(own, own, x, y, code, k, None) for own in _runs(groups)])

    parts = [] if small is None else [fold_groups(small, by, fold, schema)]
    return reduce(DataFrame.unionByName, parts + ([] if large is None else [_nearest_by_cells(large, by, k, crowd, schema)]))


def _nearest_by_cells(known: DataFrame, by: list[str], k: int, crowd: int, schema: str) -> DataFrame:
    """In each round a point looks at its own cell and the eight around it, and counts only what is nearer than that block's edge; a point that has k such
    neighbours is settled, the others go on with cells twice as wide. A point asks in its cell only, where the points of the eight around it are sent to, and
    only what is found leaves the task. The first cells hold about as many points as make most settle, and no cell over `crowd` distinct places; of one place
    only the k + 1 first points can be neighbours of any, and points after them have the first k for theirs.
    """
    first = Window.partitionBy(*by, "cx", "cy").orderBy("pos")
    firsts = F.array(*(F.nth_value("pos", i).over(first.rowsBetween(Window.unboundedPreceding, Window.currentRow)) for i in range(1, k + 1)))
    known = written(known.select("*", F.row_number().over(first).alias("__n"), firsts.alias("__firsts")).withColumn("__firsts", F.when(F.col("__n") > k + 1, F.col("__firsts"))), "points")
    others = known.where(F.col("__n") <= k + 1).select(*by, "pos", "cx", "cy")
    behind = known.where(F.col("__n") > k + 1).select(*by, "pos", F.posexplode("__firsts").alias("rank", "other")).select(*by, "pos", (F.col("rank") + 1).alias("rank"), "other", F.lit(0.0).alias("distance"))
    extents = others.groupBy(*by).agg(F.count("*").alias("n"), (F.max("cx") - F.min("cx")).alias("w"), (F.max("cy") - F.min("cy")).alias("h"))
    n, side, widest = extents.agg(F.sum("n"), F.expr("sum(n * sqrt(greatest(w * h, 0) / n)) / sum(n)"), F.max(F.greatest("w", "h"))).first()
    side = (side or 1.0) * 2 * (2 * k / 3.14159) ** 0.5 or 1.0
    for _ in range(60):
        places = others.select(*by, _cell(F.col("cx"), F.lit(side)).alias("gx"), _cell(F.col("cy"), F.lit(side)).alias("gy")).groupBy(*by, "gx", "gy").count()
        if (places.agg(F.max("count")).first()[0] or 0) <= crowd * (k + 1):
            break
        side /= 2

    def fold(table: pa.Table, groups: np.ndarray) -> pa.Table:
        x, y, code, asks, edge = (*(numbers(table, c) for c in ("cx", "cy")), _codes(table.column("pos")), numbers(table, "asks"), numbers(table, "edge"))
        runs = [(own[asks[own]], own[~asks[own]]) for own in _runs(groups)]
        return _ranked(table, by, code, [_nearest_of(a, o, x, y, code, k, edge) for a, o in runs if len(a) and len(o)])

    asking, found = others, [behind]
    while True:
        last, s = side > (widest or 0.0), F.lit(side)
        x, y = _cell(F.col("cx"), s), _cell(F.col("cy"), s)
        edge = F.least(F.col("cx") - (x - 1) * s, (x + 2) * s - F.col("cx"), F.col("cy") - (y - 1) * s, (y + 2) * s - F.col("cy"))
        asked = asking.select(*by, "pos", "cx", "cy", x.alias("gx"), y.alias("gy"), F.lit(True).alias("asks"), (F.lit(float("inf")) if last else edge).alias("edge"))
        near = others.withColumn("gx", F.explode(F.sequence(x - 1, x + 1))).select("*", F.explode(F.sequence(y - 1, y + 1)).alias("gy"), F.lit(False).alias("asks"), F.lit(0.0).alias("edge"))
        if found[1:]:  # few points are left, and only what is near them is sent
            near = near.join(asked.select(*by, "gx", "gy").distinct(), [*by, "gx", "gy"], "left_semi")
        ranked = written(fold_groups(asked.unionByName(near), [*by, "gx", "gy"], fold, schema), "ranked")
        if last:
            found.append(ranked)
            break
        settled = ranked.where(F.col("rank") == k).select(*by, "pos")
        found.append(ranked.join(settled, [*by, "pos"], "left_semi"))
        asking = written(asking.join(settled, [*by, "pos"], "left_anti"), "asking")
        if asking.isEmpty():
            break
        side *= 2
    return reduce(DataFrame.unionByName, found)


def nearest_boxes(boxes: DataFrame, by: list[str], k: int) -> DataFrame:
    """The k nearest other boxes of the frame by distance of centres."""
    return nearest(boxes.select(*by, "pos", ((F.col("x1") + F.col("x2")) / 2).alias("cx"), ((F.col("y1") + F.col("y2")) / 2).alias("cy")), by, k)
