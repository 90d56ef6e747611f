"""Kernel densities by cells against sums over all pairs."""

import math

import numpy as np
import pytest

from fieldloom.operators import density as D
from fieldloom.operators import grouped
from fieldloom.operators import measuring as M


def plain(points):
    """Densities with Scott's bandwidth, by all pairs."""
    n, d = points.shape
    spread = np.atleast_2d(np.cov(points.T)) * n ** (-2 / (d + 4))
    away = points[:, None, :] - points[None, :, :]
    squared = np.einsum("abi,ij,abj->ab", away, np.linalg.inv(spread), away)
    return np.exp(-squared / 2).mean(1) / math.sqrt((2 * math.pi) ** d * np.linalg.det(spread))


@pytest.mark.parametrize("d", [1, 2, 3])
def test_dense_points_equal_all_pairs(spark, d):
    rng, rows, wanted = np.random.default_rng(d), [], {}
    for g, n in (("a", 300), ("b", 40), ("c", 5)):
        points = rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) * 30 + 100
        points[: n // 10] += rng.normal(size=(n // 10, d)) * 300  # strays
        points[-1] = points[-2]
        found = plain(points)
        wanted |= {(g, k): found[k] for k in range(n) if found[k] / found.sum() >= 0.5 / (n + 1)}
        rows += [(g, k, *map(float, p)) for k, p in enumerate(points)] + [(g, n, *[float("nan")] * d)]
    axes = [f"v{k}" for k in range(d)]
    df = spark.createDataFrame(rows, ["g", "pos", *axes])
    got = {(r.g, r.pos): r.density for r in D.dense_points(df, ["g"], axes).collect()}
    assert got.keys() == wanted.keys() and 0 < len(got) < len(rows) - 3
    assert all(math.isclose(got[k], wanted[k], rel_tol=1e-8) for k in wanted)


def test_dense_points_edges(spark):
    schema = "g string, pos long, x double, y double, density string, __n long"
    assert D.dense_points(spark.createDataFrame([], schema.replace(", __n long", "")), ["g"], ["x", "y"]).count() == 0
    rows = [("one", 1, 1.0, 2.0, "q"), ("line", 2, 1.0, 1.0, "q"), ("line", 3, 2.0, 2.0, "q"), ("line", 4, 3.0, 3.0, "q"), ("gone", 5, None, 1.0, "q"), ("gone", 6, float("inf"), 1.0, "q"), (None, 7, 1.0, 1.0, "q")]
    got = D.dense_points(spark.createDataFrame(rows, schema.replace(", __n long", "")), ["g"], ["x", "y"])
    assert sorted((r.pos, r.density) for r in got.collect()) == [(1, None), (2, None), (3, None), (4, None)]
    same = [("s", 1, 0.0, 0.0), ("s", 2, 0.0, 0.0), ("s", 3, 4.0, 0.0), ("s", 3, 4.0, 0.0), ("s", 4, 0.0, 4.0), ("s", 5, -0.0, 4.0)]
    assert D.dense_points(spark.createDataFrame(same, "g string, pos long, x double, y double"), ["g"], ["x", "y"]).count() == 6


def test_merged_places_stay_within_their_error(spark):
    rng = np.random.default_rng(8)
    points = rng.normal(size=(3000, 2)) * 20
    df = spark.createDataFrame([("g", k, *map(float, p)) for k, p in enumerate(points)], "g string, pos long, x double, y double")
    exact = {r.pos: r.density for r in D.kernel_means(df, ["g"], ["x", "y"]).collect()}
    merged = {r.pos: r.density for r in D.kernel_means(df, ["g"], ["x", "y"], merge=0.5).collect()}
    assert exact.keys() == merged.keys() and max(abs(exact[k] - merged[k]) for k in exact) <= 0.25
    away = ((points[:, None] - points[None]) ** 2).sum(-1)
    assert np.allclose([exact[k] for k in range(3000)], np.exp(-away / 2).mean(1), atol=1e-11)


def test_no_join_of_all_pairs(spark):
    rng = np.random.default_rng(9)
    rows = [("s", 1, k, *map(float, p)) for k, p in enumerate(rng.uniform(0, 10000, (2000, 4)))]
    out = M.densities(spark.createDataFrame(rows, "scan_id string, frame int, pos long, x1 double, y1 double, x2 double, y2 double"), ["scan_id", "frame"], 20.0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "__c0" in plan and "NestedLoop" not in plan and "Cartesian" not in plan and out.count() == 2000


def test_small_groups_are_folded_and_large_ones_cut(spark, monkeypatch):
    rng = np.random.default_rng(10)
    rows = [(g, k, *map(float, rng.normal(size=2) * 30)) for g, n in (("a", 60), ("b", 90), ("c", 1), (None, 5)) for k in range(n)] + [("a", 99, float("nan"), 1.0), ("d", 1, 2.0, 2.0), ("d", 2, 2.0, 2.0)]
    df, seen = spark.createDataFrame(rows, "g string, pos long, x double, y double"), {}
    for whole in (1024, 70, 0):
        monkeypatch.setattr(grouped, "WHOLE", whole)
        for name, make in (("means", D.kernel_means), ("dense", D.dense_points)):
            out = make(df, ["g"], ["x", "y"])
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert "MapInArrow" in plan and "Join" not in plan or whole < 1024 and "Join" in plan
            got = {(r.g, r.pos): -1.0 if r.density is None else r.density for r in out.collect()}
            want = seen.setdefault(name, got)
            assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)
    assert len(seen["means"]) == 153 and 60 < len(seen["dense"]) < 153


def test_distinct_densities_are_those_of_a_shuffled_distinct(spark, monkeypatch):
    """Numbers that occur twice in a frame, with equal and with other densities, in small and in large frames; nothing is shuffled after the fold."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(4)
    rows = [(g, f, int(rng.integers(0, 30)) if k % 7 else None, *map(float, rng.integers(0, 6, 2) * 40)) for g in (0, 1) for f, n in ((0, 90), (1, 25), (2, 1)) for k in range(n)]
    boxes = spark.createDataFrame([(*r[:3], r[3], r[4], r[3] + 20, r[4] + 30) for r in rows] + [(None, 0, 1, 0.0, 0.0, 1.0, 1.0)], "scan_id long, frame long, pos long, x1 double, y1 double, x2 double, y2 double")
    by, plan = ["scan_id", "frame"], lambda df: df._jdf.queryExecution().executedPlan().toString()
    wanted = sorted(map(repr, M.densities(boxes, by, 150.0).select(*by, "pos", F.round("density", 2).alias("density")).distinct().collect()))
    got = M.distinct_densities(boxes, by, 150.0, 2)
    assert plan(got).count("Exchange hashpartitioning") == 1
    assert sorted(map(repr, got.collect())) == wanted and 10 < len(wanted) < len(rows)
    monkeypatch.setattr(grouped, "WHOLE", 40)
    assert sorted(map(repr, M.distinct_densities(boxes, by, 150.0, 2).collect())) == wanted
