"""Plots that lie over each other in great numbers."""

from pyspark.sql import functions as F

from fieldloom.operators import spatial


def test_rings_behind_a_full_cell_are_not_gathered_or_broadcast(spark, monkeypatch):
    sizes = {}

    def written(rows, label, real=spatial.written):
        out = real(rows, label)
        sizes[label] = out
        return out

    monkeypatch.setattr(spatial, "written", written)
    ring = F.array(*(F.struct(F.lit(float(x)).alias("lon"), F.lit(float(y)).alias("lat")) for x, y in [(0, 0), (8, 0), (8, 8), (0, 8)]))
    plots = spark.range(1, 301).select(F.concat(F.lit("p"), "id").alias("plot"), F.col("id").alias("place"), ring.alias("ring"))
    points = spark.createDataFrame([(4.1, 4.1), (9.5, 9.5), (None, 1.0)], "lat double, lon double")
    got = spatial.located(points, plots)
    assert [r.plot for r in got.orderBy(F.col("lat").asc_nulls_last()).collect()] == ["p1", "global", "global"]
    inner = sizes["cells"].where(F.exists("__near", lambda p: p["ring"].isNull()))
    assert inner.count() and {n for (n,) in inner.select(F.size("__near")).collect()} == {1}
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()


def test_cells_of_rings_are_told_without_joins_and_only_few_full_ones_are_broadcast(spark, monkeypatch):
    plans = {}

    def written(rows, label, real=spatial.written):
        plans[label] = rows._jdf.queryExecution().sparkPlan().toString()
        return real(rows, label)

    monkeypatch.setattr(spatial, "written", written)
    corners = [(0, 0), (9, 0), (9, 8), (4, 3), (0, 8)]
    x, y = F.col("id") % 37, F.col("id") % 41
    ring = F.array(*(F.struct((x + i).cast("double").alias("lon"), (y + j).cast("double").alias("lat")) for i, j in corners))
    plots = spark.range(300).select(F.concat(F.lit("p"), "id").alias("plot"), F.col("id").alias("place"), ring.alias("ring"))
    points = spark.range(900).select("id", (F.col("id") % 30 * 1.5 + 0.3).alias("lon"), (F.floor(F.col("id") / 30) * 1.6 + 0.7).alias("lat"))
    got = {few: {r.id: r.plot for r in spatial.located(points, plots).collect()} for few in (spatial.FEW_CELLS, 0) if monkeypatch.setattr(spatial, "FEW_CELLS", few) is None}

    def inside(px, py, k):
        a = [(k % 37 + i, k % 41 + j) for i, j in corners]
        return sum((ay > py) != (by > py) and px < (bx - ax) * (py - ay) / (by - ay) + ax for (ax, ay), (bx, by) in zip(a, a[1:] + a[:1])) % 2

    want = {k: next((f"p{p}" for p in range(300) if inside(k % 30 * 1.5 + 0.3, k // 30 * 1.6 + 0.7, p)), "global") for k in range(900)}
    assert got[0] == want and all(g == want for g in got.values()) and len(set(want.values())) > 50
    assert "Join" not in plans["full"]
    assert not any("Broadcast" in p for p in plans.values())  # the last run, in which no cell was few
