"""Kernel densities of points within groups, and the filter by density: many small groups are folded in a call, in large ones partners are found by cells."""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from ..shared import written
from .grouped import fold_groups, near_steps, parted, ranked


def _finite(axes: list[str]) -> Column:
    return reduce(and_, (F.col(a).isNotNull() & ~F.isnan(a) & (F.abs(F.col(a)) < float("inf")) for a in axes))


def _reach(error: float) -> float:
    return math.sqrt(2 * math.log(1 / error))


def _numbers(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).cast(pa.float64()).to_numpy()


def _means(groups: np.ndarray, at: list[np.ndarray], reach: float) -> np.ndarray:
    """The means of `kernel_means` of rows of many groups, with their places in each axis."""
    sums, ends = np.ones(len(groups)), at[0] + reach * (1 + 1e-9) + np.abs(at[0]) * 1e-12
    for i, j in near_steps(groups, at[0], ends):
        squared = sum((a[i] - a[j]) ** 2 for a in at)
        value = np.where(squared <= reach * reach, np.exp(-squared / 2), 0.0)
        sums[i] += value  # no row is twice on one side of a step
        sums[j] += value
    return sums / np.bincount(groups)[groups]


def kernel_means(points: DataFrame, by: list[str], axes: list[str], error: float = 1e-12, merge: float | None = None) -> DataFrame:
    """`points` with `density`: the mean over the group's rows of a kernel; see `_cell_means`, which has what is said of them, for large groups and for `merge`."""
    known = points.where(_finite(axes)).drop("density")
    small, large = (None, known) if merge is not None else parted(known, by)

    def fold(table: pa.Table, groups: np.ndarray) -> pa.Table:
        return table.append_column("density", pa.array(_means(groups, [_numbers(table, a) for a in axes], _reach(error))))

    parts = [] if small is None else [fold_groups(small, by, fold, StructType([*known.schema.fields, StructField("density", DoubleType())]))]
    return reduce(DataFrame.unionByName, parts + ([] if large is None else [_cell_means(large, by, axes, error, merge)]))


def _earlier(groups: np.ndarray, codes: np.ndarray, density: np.ndarray) -> pa.Array:
    """For each row the densities of the rows before it that have its group and code; null where there are none."""
    order = np.lexsort((codes, groups))
    again = np.flatnonzero((groups[order][1:] == groups[order][:-1]) & (codes[order][1:] == codes[order][:-1]))
    out: list[list[float] | None] = [None] * len(groups) if len(again) else []
    for before, row in zip(order[again], order[again + 1]):
        out[row] = [*(out[before] or []), float(density[before])]
    return pa.array(out, pa.list_(pa.float64())) if out else pa.nulls(len(groups), pa.list_(pa.float64()))


def distinct_means(points: DataFrame, by: list[str], key: str, axes: list[str], width: float, decimals: int, error: float = 1e-12) -> DataFrame:
    """(by, key, density) of `kernel_means` in bandwidths of `width`, rounded, each different row once.

    Equal rows are of one group, so those of a small group are found in its fold, and nothing is shuffled after it; only `key` and `axes` are before.
    """
    known = points.where(_finite(axes)).select(*by, key, *axes)
    small, large = parted(known, by)
    names, rounded = [f"__k{k}" for k in range(len(axes))], F.round("density", decimals).alias("density")

    def fold(table: pa.Table, groups: np.ndarray) -> pa.Table:
        density = _means(groups, [_numbers(table, a) / width for a in axes], _reach(error))
        return table.select([*by, key]).append_column("density", pa.array(density)).append_column("__earlier", _earlier(groups, ranked(table, key), density))

    parts = []
    if small is not None:
        schema = StructType([*known.select(*by, key).schema.fields, StructField("density", DoubleType()), StructField("__earlier", ArrayType(DoubleType()))])
        found = fold_groups(small, by, fold, schema).select(*by, key, rounded, "__earlier")
        parts.append(found.where(F.col("__earlier").isNull() | ~F.exists("__earlier", lambda d: F.round(d, decimals) == F.col("density"))).drop("__earlier"))
    if large is not None:
        scaled = large.select(*by, key, *((F.col(a) / F.lit(float(width))).alias(n) for a, n in zip(axes, names)))
        parts.append(_cell_means(scaled, by, names, error, None).select(*by, key, rounded).distinct())
    return reduce(DataFrame.unionByName, parts)


def _cell_means(points: DataFrame, by: list[str], axes: list[str], error: float, merge: float | None) -> DataFrame:
    """`points` with `density`: the mean over the group's rows, the row itself included, of exp(-d² / 2), d being the distance in `axes` (in bandwidths).

    Rows further away than the kernel's value `error` are left out, so a density is too small by `error` at most. Equal places are one, with their
    number of rows. With `merge`, so are the places of a square of that side, at their mean: a kernel's value is off by (number of axes) merge² / 2 at
    most, and a row has a bounded number of partners however many rows the group has. Rows with a null in `by` or without finite axes are left out.
    """
    reach = _reach(error)
    names = list(range(len(axes)))
    known = points.where(_finite(axes)).drop("density")
    square = [F.col(a).alias(f"__s{k}") if merge is None else F.floor(F.col(a) / merge).alias(f"__s{k}") for k, a in zip(names, axes)]
    place = [F.first(a) if merge is None else F.avg(a) for a in axes]
    others = known.groupBy(*by, *square).agg(F.count("*").alias("__n"), *(p.cast("double").alias(f"__o{k}") for k, p in zip(names, place)))
    others = others.select(*by, "__n", *(f"__o{k}" for k in names), *(F.floor(F.col(f"__o{k}") / reach).alias(f"__c{k}") for k in names))
    asked = known.select(*by, *axes).distinct()
    for k, a in zip(names, axes):
        cell = F.floor(F.col(a) / reach)
        asked = asked.withColumn(f"__c{k}", F.explode(F.sequence(cell - 1, cell + 1)))
    squared = sum(((F.col(a) - F.col(f"__o{k}")) * (F.col(a) - F.col(f"__o{k}")) for k, a in zip(names, axes)), F.lit(0.0))
    near = asked.join(others, [*by, *(f"__c{k}" for k in names)]).withColumn("__d", squared).where(F.col("__d") <= reach * reach)
    sums = near.groupBy(*by, *axes).agg(F.sum(F.col("__n") * F.exp(-F.col("__d") / 2)).alias("__sum"))
    rows = known.groupBy(*by).agg(F.count("*").alias("__rows"))
    joined = known.join(sums, [*by, *axes]).join(rows, by)
    return joined.select(*known.columns, (F.col("__sum") / F.col("__rows")).alias("density"))


def whitened(points: DataFrame, by: list[str], axes: list[str]) -> DataFrame:
    """`points` with `__w0`, `__w1`, …: their axes in bandwidths after Scott, in which the group's covariance (of the sample) is round, and `__peak`, the
    kernel's height. The covariance's Cholesky factor is written out in columns. Null where the group has no such factor: under two rows, or all on a line.
    """
    n, d = F.col("__n"), len(axes)
    sums = [F.covar_samp(a, b).alias(f"__v{i}{j}") for i, a in enumerate(axes) for j, b in enumerate(axes[: i + 1])]
    figures = points.where(_finite(axes)).groupBy(*by).agg(F.count("*").alias("__n"), *(F.avg(a).alias(f"__m{k}") for k, a in enumerate(axes)), *sums)
    for i in range(d):
        for j in range(i + 1):
            left = F.col(f"__v{i}{j}") - sum((F.col(f"__l{i}{k}") * F.col(f"__l{j}{k}") for k in range(j)), F.lit(0.0))
            root = F.when(left > 1e-12 * F.col(f"__v{i}{i}"), F.sqrt(left))
            figures = figures.withColumn(f"__l{i}{j}", root if i == j else F.try_divide(left, F.col(f"__l{j}{j}")))
    width = F.pow(n, F.lit(-1.0 / (d + 4)))
    volume = F.lit((2 * math.pi) ** (d / 2))
    for k in range(d):
        volume = volume * width * F.col(f"__l{k}{k}")
    figures = figures.withColumn("__width", width).withColumn("__peak", F.try_divide(F.lit(1.0), volume))
    out = points.join(figures, by)
    for i, a in enumerate(axes):
        rest = sum((F.col(f"__l{i}{k}") * F.col(f"__z{k}") for k in range(i)), F.lit(0.0))
        out = out.withColumn(f"__z{i}", F.try_divide(F.col(a) - F.col(f"__m{i}") - rest, F.col(f"__l{i}{i}")))
    return out.select(*points.columns, "__peak", *((F.col(f"__z{k}") / F.col("__width")).alias(f"__w{k}") for k in range(d)))


def dense_points(points: DataFrame, by: list[str], axes: list[str], least: float = 0.5, error: float = 1e-12, merge: float | None = None) -> DataFrame:
    """The points of at least `least` times the even share of their group's density, with `density`, that of a Gaussian kernel with Scott's bandwidth.

    The even share is one over the group's rows, those without finite axes included, which themselves go. Groups without a bandwidth (see `whitened`)
    keep all their finite points, with a null density; rows with a null in `by` go. Repeated rows all count and all stay. An empty table gives none.
    """
    own = points.drop("density")
    small, large = (None, own) if merge is not None else parted(own, by)

    def fold(table: pa.Table, groups: np.ndarray) -> pa.Table:
        places = [_numbers(table, a) for a in axes]
        fine = np.flatnonzero(np.logical_and.reduce([np.isfinite(p) for p in places]))
        g = groups[fine]
        at, peak = _round([p[fine] for p in places], g, int(groups[-1]) + 1)
        flat = np.isnan(peak[g])
        density = np.full(len(g), np.nan)
        density[~flat] = _means(g[~flat], [a[~flat] for a in at], _reach(error)) * peak[g[~flat]] if not flat.all() else 0.0
        whole = np.bincount(g[~flat], density[~flat], len(peak))[g]
        with np.errstate(divide="ignore", invalid="ignore"):
            kept = flat | (density / whole >= least / np.bincount(groups)[g])
        return table.take(fine[kept]).append_column("density", pa.array(density[kept], mask=flat[kept]))

    parts = [] if small is None else [fold_groups(small, by, fold, StructType([*own.schema.fields, StructField("density", DoubleType())]))]
    return reduce(DataFrame.unionByName, parts + ([] if large is None else [_dense_cells(large, by, axes, least, error, merge)]))


def _round(places: list[np.ndarray], groups: np.ndarray, n_groups: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The coordinates and each group's peak of `whitened`, nan where a group has no bandwidth."""
    d, n = len(places), np.bincount(groups, minlength=n_groups).astype(float)
    total = lambda v: np.bincount(groups, v, n_groups)
    with np.errstate(divide="ignore", invalid="ignore"):
        off = [p - (total(p) / n)[groups] for p in places]
        root = {}
        for i in range(d):
            for j in range(i + 1):
                own = total(off[i] * off[j]) / np.where(n > 1, n - 1, np.nan)
                left = own - sum(root[i, k] * root[j, k] for k in range(j))
                root[i, j] = left / root[j, j] if i != j else np.where(left > 1e-12 * own, np.sqrt(left), np.nan)
        width = n ** (-1.0 / (d + 4))
        peak = 1 / ((2 * math.pi) ** (d / 2) * np.prod([width * root[k, k] for k in range(d)], axis=0))
        at: list[np.ndarray] = []
        for i in range(d):
            rest = sum(root[i, k][groups] * at[k] for k in range(i))
            at.append((off[i] - rest) / root[i, i][groups])
        return [a / width[groups] for a in at], peak


def _dense_cells(own: DataFrame, by: list[str], axes: list[str], least: float, error: float, merge: float | None) -> DataFrame:
    """`dense_points` of large groups."""
    ready = written(whitened(own, by, axes), "whitened")  # the same coordinates wherever they are compared
    round_axes = [f"__w{k}" for k in range(len(axes))]
    found = _cell_means(ready, by, round_axes, error, merge).withColumn("density", F.col("density") * F.col("__peak"))
    found = written(found.select(*own.columns, "density"), "densities")
    totals = found.groupBy(*by).agg(F.sum("density").alias("__all")).join(own.groupBy(*by).agg(F.count("*").alias("__rows")), by)
    kept = found.join(totals, by).where(F.col("density") / F.col("__all") >= least / F.col("__rows")).select(*own.columns, "density")
    flat = ready.where(_finite(axes) & F.col("__peak").isNull()).select(*own.columns, F.lit(None).cast("double").alias("density"))
    return kept.union(flat)
