"""Points in many plots, and nearest neighbours, against brute force."""

import numpy as np

from pyspark.sql import functions as F

from fieldloom.operators import geometry, spatial

PLOT = "plot string, place int, ring array<struct<lon:double,lat:double>>"


def stars(rng, n, spread=10.0):
    """Rings of 3 to 9 corners around a middle, of very different sizes, some thin, some notched."""
    out = []
    for k in range(n):
        m = int(rng.integers(3, 10))
        angle = np.sort(rng.uniform(0, 2 * np.pi, m))
        size = 10 ** rng.uniform(-3, 0.3) if k % 50 else 4.0
        radius = size * rng.uniform(0.2, 1, m)
        x, y = rng.uniform(0, spread, 2)
        thin = 0.02 if k % 9 == 0 else 1.0
        out.append((f"p{k}", k, [(float(x + r * np.cos(a)), float(y + thin * r * np.sin(a))) for r, a in zip(radius, angle)]))
    return out


def first_by_brute_force(xs, ys, plots):
    best = np.full(len(xs), -1)
    for _, place, ring in reversed(plots):
        inside = np.zeros(len(xs), bool)
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
            if ay != by:
                inside ^= ((ay > ys) != (by > ys)) & (xs < (bx - ax) * (ys - ay) / (by - ay) + ax)
        best[inside] = place
    return best


def test_many_plots_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    plots = stars(rng, 20_000)
    xs, ys = rng.uniform(-0.5, 10.5, 400), rng.uniform(-0.5, 10.5, 400)
    xs[:100] = 5.0  # a third of the points in one place
    ys[:100] = 5.0
    points = spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in enumerate(zip(xs, ys))], "id int, lon double, lat double")
    out = spatial.locate(points, spark.createDataFrame(plots, PLOT))
    assert not any(bad in out._jdf.queryExecution().toString() for bad in ("NestedLoop", "Cartesian"))
    got = {r.id: r.plot for r in out.collect()}
    want = first_by_brute_force(xs, ys, plots)
    assert got == {k: f"p{b}" if b >= 0 else "global" for k, b in enumerate(want)}
    some = spark.createDataFrame([p for p in plots if p[1] % 40 == 7], PLOT)
    got = {r.id: r.inside for r in spatial.in_any(points, some).collect()}
    assert got == {k: bool(b >= 0) for k, b in enumerate(first_by_brute_force(xs, ys, [p for p in plots if p[1] % 40 == 7]))}


def test_plots_edges(spark):
    """No plots, empty and flat rings, points without coordinates, repeated points, clashing columns."""
    points = spark.createDataFrame([(1, 0.5, 0.5, 9), (1, 0.5, 0.5, 9), (2, None, 0.5, 9), (3, 7.0, 7.0, 9)], "id int, lon double, lat double, gx int")
    rows = [(f"e{k}", k, []) for k in range(40)] + [(f"f{k}", 40 + k, [(1.0, 1.0), (2.0, 2.0)]) for k in range(40)] + [("square", 99, [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)])]
    got = spatial.locate(points, spark.createDataFrame(rows, PLOT))
    assert got.columns == ["id", "lon", "lat", "gx", "plot"]
    assert sorted((r.id, r.plot) for r in got.collect()) == [(1, "square"), (1, "square"), (2, "global"), (3, "global")]
    assert {r.plot for r in spatial.locate(points, spark.createDataFrame([], PLOT)).collect()} == {"global"}
    assert {r.plot for r in spatial.located(points, spark.createDataFrame([], PLOT)).collect()} == {"global"}


def nearest_by_brute_force(rows, k):
    out = []
    for g, pos, x, y in rows:
        others = sorted((float(np.sqrt((x - ox) ** 2 + (y - oy) ** 2)), o) for h, o, ox, oy in rows if h == g and o != pos)
        out += [(g, pos, n + 1, o, d) for n, (d, o) in enumerate(others[:k])]
    return sorted(out)


def test_nearest_equal_brute_force(spark):
    """Clusters of very different density, one place that holds a third of all points, small groups, a lone point."""
    rng = np.random.default_rng(2)
    spots = np.concatenate([rng.uniform(0, 1000, (150, 2)), 500 + rng.normal(0, 0.01, (150, 2)), np.full((150, 2), 77.0), rng.integers(0, 12, (80, 2)).astype(float)])
    rows = [(0, int(p), float(x), float(y)) for p, (x, y) in zip(rng.permutation(len(spots)), spots)]
    rows += [(1, 1, 0.0, 0.0), (1, 2, 3.0, 4.0), (2, 1, 5.0, 5.0)]
    df = spark.createDataFrame([*rows, (0, 9999, None, 1.0)], "g int, pos long, cx double, cy double")
    got = spatial.nearest(df, ["g"], 4)
    assert sorted((r.g, r.pos, r.rank, r.other, r.distance) for r in got.collect()) == nearest_by_brute_force(rows, 4)
    assert spatial.nearest(df.limit(0), ["g"], 4).count() == 0


def test_nearest_shuffle_no_pairs(spark, monkeypatch):
    """Small groups take one shuffle and no join; cells take the same rows, with places of many points and far strays."""
    from fieldloom.operators import grouped

    rng = np.random.default_rng(5)
    spots = np.concatenate([rng.integers(0, 6, (90, 2)), rng.integers(0, 900, (40, 2)), np.full((60, 2), 3), [[10**6, 1]]]).astype(float)
    rows = [(g, int(p), float(x), float(y)) for g in (0, 1) for p, (x, y) in zip(rng.permutation(len(spots)), spots)]
    df = spark.createDataFrame(rows, "g int, pos long, cx double, cy double")
    for whole in (1024, 0):
        monkeypatch.setattr(grouped, "WHOLE", whole)
        got = spatial.nearest(df, ["g"], 3)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert whole == 0 or "MapInArrow" in plan and "Join" not in plan and "Window" not in plan
        assert sorted((r.g, r.pos, r.rank, r.other, r.distance) for r in got.collect()) == nearest_by_brute_force(rows, 3)


def test_insets_keep_a_margin_from_every_edge(spark):
    """Convex, notched and thin rings: inside, and no point along the edges is nearer than the margin."""
    rng = np.random.default_rng(7)
    rings = [[(0, 0), (10, 0), (10, 10), (0, 10)], [(0, 0), (10, 0), (10, 10), (5, 2), (0, 10)], [(0, 0), (10, 0), (10, 1.5), (0, 1.5)], [(2, 2), (8, 2), (2, 2)]]
    points = [(k, float(x), float(y)) for k, (x, y) in enumerate(rng.uniform(-1, 11, (150, 2)))] + [(900, None, 1.0)]
    df = spark.createDataFrame(points, "id int, lon double, lat double")
    for ring in rings:
        own = spark.createDataFrame([("r", 1, [(float(a), float(b)) for a, b in ring])], PLOT)
        got = {r.id: r["in"] for r in df.crossJoin(own).select("id", geometry.in_inset(F.col("lat"), F.col("lon"), F.col("ring"), 1.0).alias("in")).collect()}
        along = np.concatenate([np.linspace(a, b, 2001) for a, b in zip(np.array(ring, float), np.array(ring[1:] + ring[:1], float))])
        for k, x, y in points[:-1]:
            far = np.sqrt(((along - [x, y]) ** 2).sum(axis=1)).min()
            if abs(far - 1.0) > 0.01:
                assert got[k] == bool(far > 1.0 and first_by_brute_force(np.array([x]), np.array([y]), [("r", 1, ring)])[0] == 1), (ring, x, y)
        assert got[900] is False
