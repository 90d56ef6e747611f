"""Small fixtures, one for each trap of the semantics."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fieldloom import schemas
from fieldloom.operators import annotations, counting, evaluation, folds, geometry, ledger, matching, spatial, timeseries, tracking
from fieldloom.sources import readers, writers


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_containment_is_strict_and_zero_trees_stay(spark):
    tracks = spark.createDataFrame([(0, 1, 10, 10, 50, 1.0), (0, 1, 11, 11, 50, 1.0), (0, 1, 12, 11, 100, 1.0)], "scan_id int, frame int, track_id int, x1 int, x2 int, depth double")
    slices = spark.createDataFrame([(0, 1, 1, 10, 100), (0, 1, 2, 500, -1)], "scan_id int, frame int, tree_id int, start int, end int")
    out = counting.tree_counts(tracks, slices, ["scan_id"])
    assert rows(out) == [(0, 1, 1, 0, 0), (0, 2, 0, 0, 0)]


def test_missing_frames_are_open(spark):
    slices = spark.createDataFrame([(0, 1, 1, 10, 100), (0, 3, 1, 20, 90)], "scan_id int, frame int, tree_id int, start int, end int")
    assert rows(counting.densify(slices, ["scan_id"])) == [(0, 1, 1, 10, 100), (0, 1, 2, -1, -1), (0, 1, 3, 20, 90)]


def test_depth_modes(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 3.0), (3, 4.0), (4, None), (5, math.nan)], "id int, depth double")
    assert [r.id for r in df.where(counting.within_depth(3.0)).orderBy("id").collect()] == [1]
    assert [r.id for r in df.where(counting.within_depth(3.0, "drop_above")).orderBy("id").collect()] == [1, 2, 4, 5]


def test_null_keys_are_equal_in_the_ledger(spark):
    done = spark.createDataFrame([("a", None), ("b", "1")], "plot string, row string")
    shipped = spark.createDataFrame([("a", None)], "plot string, row string")
    assert rows(ledger.pending(done, shipped, ["plot", "row"])) == [("b", "1")]


@pytest.mark.parametrize("direction,tie,strict,want", [("backward", "earlier", False, ["p", "q", "q", None]), ("forward", "earlier", True, ["q", "r", "r", "p"]), ("nearest", "earlier", False, ["p", "q", "q", "p"]), ("nearest", "later", False, ["q", "q", "r", "p"])])
def test_asof(spark, direction, tie, strict, want):
    at = lambda s: f"2024-01-01 00:00:{s:06.3f}"
    fixes = spark.createDataFrame([(1, at(10), "p"), (1, at(11), "q"), (1, at(13), "r")], "k int, t string, v string").withColumn("ts", F.to_timestamp_ntz("t")).drop("t")
    frames = spark.createDataFrame([(1, at(10.5), 0), (1, at(11), 1), (1, at(12), 2), (1, at(1), 3)], "k int, t string, n int").withColumn("ts", F.to_timestamp_ntz("t")).drop("t")
    out = timeseries.asof(frames, fixes, ["k"], "ts", "v", direction, tie=tie, strict=strict)
    assert [r.v for r in out.orderBy("n").collect()] == want
    near = timeseries.asof(frames, fixes, ["k"], "ts", "v", "nearest", tolerance_us=1_000_000)
    assert [r.v for r in near.orderBy("n").collect()] == ["p", "q", "q", None]


def test_heading_wraps_and_holds(spark):
    df = spark.createDataFrame([(0, 0, 0.0, 0.0), (0, 1, 1.0, -0.01), (0, 2, 1.0, -0.01), (0, 3, 2.0, 0.0)], "k int, n int, lat double, lon double")
    got = [r.heading for r in timeseries.headings(df, ["k"], "n").orderBy("n").collect()]
    assert got[0] is None and 359 < got[1] < 360 and got[2] == got[1] and 0 < got[3] < 1
    inside = df.select(timeseries.in_heading_range(F.lit(355.0), 350.0, 10.0)).first()[0]
    assert inside


def test_moving_average_pads_with_zero(spark):
    df = spark.createDataFrame([(0, n, 10.0) for n in range(12)], "k int, n int, v double")
    got = [r.average for r in timeseries.moving_average(df, ["k"], "n", "v").orderBy("n").collect()]
    assert np.allclose(got, np.convolve(np.full(12, 10.0), np.ones(10) / 10, "same"))


def test_first_polygon_wins(spark):
    square = lambda a, b: [(a, a), (b, a), (b, b), (a, b)]
    plots = spark.createDataFrame([("big", 1, square(0.0, 10.0)), ("small", 2, square(2.0, 4.0)), ("far", 3, square(20.0, 30.0))], "plot string, place int, ring array<struct<lon:double,lat:double>>")
    points = spark.createDataFrame([(1, 3.0, 3.0), (2, 25.0, 25.0), (3, 15.0, 15.0)], "id int, lat double, lon double")
    assert [r.plot for r in spatial.locate(points, plots).orderBy("id").collect()] == ["big", "far", "global"]


def test_duplicates_are_not_transitive(spark):
    boxes = spark.createDataFrame([(0, 0, 0, 0, 100, 100), (0, 1, 30, 0, 130, 100), (0, 2, 60, 0, 160, 100)], "frame int, pos int, x1 int, y1 int, x2 int, y2 int")
    assert [r.pos for r in geometry.without_duplicates(boxes, ["frame"], 0.5).orderBy("pos").collect()] == [0]
    assert [r.pos for r in geometry.without_duplicates(boxes.where("pos <> 1"), ["frame"], 0.5).orderBy("pos").collect()] == [0, 2]


def test_greedy_pairs_by_score_then_place():
    assert geometry.greedy_pairs(np.array([[0.5, 0.9], [0.5, 0.9], [0.0, 0.0]])) == [(0, 1), (1, 0)]


def test_assignment_is_optimal():
    import itertools

    rng = np.random.default_rng(3)
    for _ in range(30):
        n, m = rng.integers(1, 5, 2)
        cost = rng.random((n, m))
        best = min(sum(cost[r, c] for r, c in zip(rs, cs)) + 0.35 * (n + m - 2 * k) for k in range(min(n, m) + 1) for rs in itertools.combinations(range(n), k) for cs in itertools.permutations(range(m), k))
        got = tracking.assignment(cost, 0.7)
        assert len({r for r, _ in got}) == len({c for _, c in got}) == len(got)
        assert math.isclose(sum(cost[r, c] for r, c in got) + 0.35 * (n + m - 2 * len(got)), best, abs_tol=1e-9)


def test_slice_machine():
    frames = [(1, None, None), (2, 100.0, None), (3, 50.0, None), (4, None, 900.0), (5, None, None), (6, 700.0, 200.0), (7, 300.0, None)]
    assert folds.tree_slices(frames[:5]) == [(2, 1, 100, -1), (3, 1, 50, -1), (4, 1, -1, 900)]
    with pytest.raises(ValueError):
        folds.tree_slices([(1, None, 5.0)])
    assert folds.tree_slices([(1, 100.0, None), (2, 700.0, 200.0), (3, 300.0, None)]) == [(1, 1, 100, -1), (2, 1, -1, 200), (2, 2, 700, -1), (3, 2, 300, -1)]
    # A whole tree, then its end and the next start: the next tree's row carries its own number.
    assert folds.tree_slices([(1, 100.0, 900.0), (2, 800.0, 50.0)]) == [(1, 1, 100, 900), (2, 1, -1, 50), (2, 2, 800, -1)]
    assert folds.border_state(500.0, 510.0, "right") == 3 and folds.border_state(500.0, 510.0, "left") == 4


def test_row_machine(spark):
    samples = [(0, n, 0.0, 0.0, 0 < n < 6, None, None) for n in range(6)] + [(0, n, 0.9, 50.0, False, None, None) for n in range(6, 10)]
    df = spark.createDataFrame(samples, "k int, n int, depth double, turn double, in_inner boolean, in_entry boolean, in_heading boolean")
    got = [(r.state, r.row_number) for r in folds.row_states(df, ["k"], "n", alpha=0.9).orderBy("n").collect()]
    assert got == [(0, 0), (1, 1), (2, 1), (2, 1), (2, 1), (2, 1), (3, 1), (0, 1), (0, 1), (0, 1)]


def test_clusters_are_greedy(spark):
    boxes = spark.createDataFrame([(0, k, 10 * k, 0, 10 * k, 0) for k in (0, 1, 5, 6, 3)], "frame int, pos long, x1 int, y1 int, x2 int, y2 int")
    got = {r.pos: r.cluster for r in folds.greedy_clusters(boxes, ["frame"], 15.0).collect()}
    assert got == {0: 0, 1: 0, 3: 1, 5: 2, 6: 2}


def test_tracker_follows_and_is_independent_of_partitions(spark):
    frames = [(s, f, 100 * f + k, 400 - 20 * f + 200 * k, 100, 450 - 20 * f + 200 * k, 150, 1.0, 20.0, 0.0) for s in (0, 1) for f in range(5) for k in range(3)]
    df = spark.createDataFrame(frames, "scan_id int, frame int, pos int, x1 int, y1 int, x2 int, y2 int, depth double, tx double, ty double")
    one = rows(tracking.window_tracks(df.repartition(1), ["scan_id"]))
    assert one == rows(tracking.window_tracks(df.repartition(7), ["scan_id"]))
    assert {(p % 100, t) for _, _, p, t in one} == {(0, 0), (1, 1), (2, 2)}


def test_two_stage_tracker_keeps_an_id(spark):
    frames = [(0, f, f, 100 + 5 * f, 100, 150 + 5 * f, 160, 0.9 if f != 2 else 0.3) for f in range(6)]
    df = spark.createDataFrame(frames, "scan_id int, frame int, pos int, x1 int, y1 int, x2 int, y2 int, score double")
    assert [r.track_id for r in tracking.two_stage_tracks(df, ["scan_id"]).orderBy("frame").collect()] == [0] * 6


def _two_stage(rows, **kw):
    pdf = pd.DataFrame([(f, k, x, 100, x + 50, 160, score) for k, (f, x, score) in enumerate(rows)], columns=["frame", "pos", "x1", "y1", "x2", "y2", "score"])
    return [(r.frame, rows[r.pos][1], r.track_id) for r in tracking.two_stage_scan(pdf, tracking.TwoStageTracker(**kw)).itertuples()]


def test_two_stage_tracker_confirms_tracks():
    still = [(f, 100, 0.9) for f in range(6)]
    assert _two_stage(still + [(3, 400, 0.9)]) == [(f, 100, 0) for f in range(6)]
    got = _two_stage(still + [(f, 400, 0.9) for f in (2, 3, 4)])
    assert sorted(got) == sorted([(f, 100, 0) for f in range(6)] + [(3, 400, 1), (4, 400, 1)])
    # 1 / 3 of overlap is within 0.7 as it is, but not when multiplied by the score
    late = [(1, 400, 0.9), (2, 425, 0.8), (3, 425, 0.8)]
    assert (2, 425, 1) in _two_stage(still + late, fused=False)
    assert (2, 425, 1) not in _two_stage(still + late) and (3, 425, 2) in _two_stage(still + late)


def test_two_stage_tracker_removes_doubled_tracks():
    come = [(f, max(100, 160 - 2 * (f - 10)), 0.9) for f in range(10, 50)]
    longer = _two_stage([(f, 100, 0.9) for f in range(16)] + come)
    assert {t for f, _, t in longer if f >= 16} == {1}
    shorter = _two_stage([(f, 100, 0.9) for f in range(35)] + come)
    assert {t for f, _, t in shorter if f >= 39} == {0} and [f for f, _, _ in shorter if f >= 35] == [f for f in range(35, 50) if f != 38]


def test_mot_counts_a_switch(spark):
    pairs = [(0, 1, 1.0, 7.0, 0.9), (0, 2, 1.0, 8.0, 0.9), (0, 3, 1.0, None, 0.0), (0, 4, None, 9.0, 0.0)]
    df = spark.createDataFrame(pairs, "scan_id int, frame int, gt_id double, trk_id double, iou double")
    got = evaluation.mot_summary(df, ["scan_id"], 0.5).first()
    assert (got.matches, got.misses, got.false_positives, got.switches) == (2, 1, 1, 1)


def test_proportional_data_has_no_error(spark):
    df = spark.createDataFrame([(g, float(x), 2.0 * x) for g in range(3) for x in range(1, 5)], "g int, x double, y double")
    assert all(math.isclose(r.factor, 2.0) and abs(r.error) < 1e-12 for r in evaluation.leave_one_group_out(df, "g", "x", "y").collect())


def test_annotations_without_an_image_go(spark):
    images = spark.createDataFrame([("a", 1), ("b", 1)], "source string, id long")
    notes = spark.createDataFrame([("a", 5, 1), ("b", 5, 1), ("b", 6, 9)], "source string, id long, image_id long")
    new_images, new_notes = annotations.renumbered(images, notes, "source")
    assert sorted(r.new_id for r in new_images.collect()) == [1, 2]
    assert sorted((r.new_id, r.new_image) for r in new_notes.collect()) == [(1, 1), (2, 2)]


def test_sources(spark, tmp_path):
    head, bare = tmp_path / "a.csv", tmp_path / "b.csv"
    body = "2024-01-01 00:00:01.500000,1.5,2.5,p1\n2024-01-01 00:00:02,,,\n"
    head.write_text("timestamp,latitude,longitude,plot\n" + body)
    bare.write_text(body)
    assert rows(readers.nav(spark, str(head))) == rows(readers.nav(spark, str(bare)))
    assert [r.plot for r in readers.nav(spark, str(head)).orderBy("timestamp").collect()] == ["p1", "global"]
    log = tmp_path / "imu.log"
    log.write_text("d1 t1\n1 2 3\n4 5 6\n\nd2 t2\n1 2 3\n4 5 7\n")
    assert [r.linear_acceleration_z for r in readers.imu_log(spark, str(log)).orderBy("date").collect()] == [6.0, 7.0]
    drops = tmp_path / "drops.log"
    drops.write_text("x FRAME DROP 7\nother 5\nx FRAME DROP 3\nx FRAME DROP 7\n")
    assert sorted(r.frame for r in readers.dropped_frames(spark, str(drops)).collect()) == [3, 6]
    table = tmp_path / "m.json"
    table.write_text("{'3': [1, 2], '10': []}")
    assert rows(readers.json_map(spark, str(table), "array<int>")) == [(3, [1, 2]), (10, [])]
    assert readers.csv(spark, str(tmp_path / "none.csv"), schemas.SLICES, missing_ok=True).count() == 0
    slices = tmp_path / "s.csv"
    slices.write_text(",frame_id,tree_id,start,end\n0,1,2,-1,5\n")
    assert rows(readers.csv(spark, str(slices), schemas.SLICES)) == [(1, 2, -1, 5)]


def test_xml_sources(spark, tmp_path):
    one = lambda n, more="": f"<object><name>f{n}</name><pose>u</pose><truncated>0</truncated><difficult>1</difficult>{more}<bndbox><xmin>{n}</xmin><ymin>2</ymin><xmax>3</xmax><ymax>4</ymax></bndbox></object>"
    voc = tmp_path / "voc"
    voc.mkdir()
    documents = ["<annotation>" + (f"<filename>im{d}.jpg</filename>" if d else "") + "\n".join(one(50 * d + k, "<part><name>x</name></part>" if k == 3 else "") for k in range(50)) + "</annotation>" for d in range(3)]
    (voc / "a.xml").write_text("<?xml version='1.0'?>\n" + "\n".join(documents[:2]) + "\n")
    (voc / "b.xml").write_text(documents[2])
    (voc / "c.xml").write_text("<annotation><filename>empty.jpg</filename></annotation>")
    assert sorted(rows(readers.voc_objects(spark, str(voc))), key=repr) == sorted(((f"im{n // 50}" if n >= 50 else None, f"f{n}", "u", 0, 1, n, 2, 3, 4) for n in range(150)), key=repr)
    for bad in ("<annotation><object><name>f</name></annotation>", "<annotation><object><name>f</name></object></annotation>", one(1).replace("<xmin>1", "<xmin>one")):
        (tmp_path / "bad.xml").write_text(bad)
        with pytest.raises(Exception):
            readers.voc_objects(spark, str(tmp_path / "bad.xml")).collect()
    kml = tmp_path / "k.kml"
    kml.write_text("<kml><Document><Placemark><name>p</name><Polygon><outerBoundaryIs><LinearRing><coordinates>\n1,2,0 3,4,0\n5,6,0 </coordinates></LinearRing></outerBoundaryIs></Polygon></Placemark></Document></kml>")
    got = readers.kml_plots(spark, str(kml)).first()
    assert got.plot == "p" and [(p.lon, p.lat) for p in got.ring] == [(1.0, 2.0), (3.0, 4.0), (5.0, 6.0)]


def test_sinks(spark, tmp_path):
    tracks = spark.createDataFrame([(1, 2, 1.0, 2.0, 3.0, 4.0, 0.5), (1, -1, 1.0, 2.0, 3.0, 4.0, 0.5)], "frame int, track_id int, x double, y double, w double, h double, score double")
    writers.mot_text(tracks, str(tmp_path / "mot"))
    assert [r.value for r in spark.read.text(str(tmp_path / "mot")).collect()] == ["1,2,1.0,2.0,3.0,4.0,0.50,-1,-1,-1"]
    ledger_rows = spark.createDataFrame([("c", "p", "010124", "1", None, "csv")], schemas.COLLECTED)
    path = str(tmp_path / "ledger")
    assert writers.append_ledger(spark, path, ledger_rows, schemas.COLLECTED).count() == 1
    assert readers.csv(spark, path, schemas.COLLECTED).count() == 1
    old, new = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, "c")], "k int, v string")
    assert rows(writers.upserted(old, new, ["k"])) == [(1, "a"), (2, "c")]


def test_average_precision_of_a_small_grid(spark):
    from fieldloom.operators import measuring

    box = "scan_id int, frame int, class int, pos int, x1 int, y1 int, x2 int, y2 int, score double"
    truth = spark.createDataFrame([(0, 1, 0, 1, 0, 0, 10, 10, 0.0), (0, 2, 0, 2, 0, 0, 10, 10, 0.0)], box)
    found = spark.createDataFrame([(0, 1, 0, 3, 0, 0, 10, 10, 0.9), (0, 1, 0, 4, 0, 0, 10, 9, 0.8), (0, 2, 0, 5, 0, 0, 10, 10, 0.7)], box)
    hits = measuring.greedy_hits(truth, found, ["scan_id", "frame"], [0.5])
    assert [r.hit for r in hits.orderBy("pos").collect()] == [1, 0, 1]
    got = measuring.recall_point_precision(hits, truth).first().ap
    assert math.isclose(got, (51 * 1.0 + 50 * 2 / 3) / 101)


def test_ellipsoid(spark):
    from fieldloom.operators import measuring

    rng = np.random.default_rng(1)
    u = rng.normal(size=(200, 3))
    p = u / np.linalg.norm(u, axis=1)[:, None] * [3, 2, 1] + [5, 1, -2]
    got = measuring.ellipsoids(spark.createDataFrame([(0, *map(float, r)) for r in p], "g int, x double, y double, z double"), ["g"]).first()
    assert np.allclose([got.cx, got.cy, got.cz, got.rx, got.ry, got.rz], [5, 1, -2, 3, 2, 1])


def test_cosine_distances_ask_for_every_vector(spark):
    df = spark.createDataFrame([(k, k % 2, [1.0, float(k)]) for k in range(9)] + [(9, None, [1.0, 1.0])], "vec_id long, label int, embedding array<float>")
    got = rows(matching.cosine_distances(df, blocks=3))
    assert [(a, b) for a, b, _ in got] == [(a, b) for a in range(9) for b in range(9) if a != b and a % 2 == b % 2]
    assert all(abs(d - (1 - (1 + a * b) / math.sqrt((1 + a * a) * (1 + b * b)))) < 1e-6 for a, b, d in got)


def test_one_file_is_found_and_old_names_are_reconciled(spark):
    files = spark.createDataFrame([("/a/row_1/0/jaized_timestamps.csv",), ("/a/row_1/0/slices.csv",), ("/a/row_2/0/slices.csv",)], "path string")
    assert readers.only_file(files, "jaized") == "/a/row_1/0/jaized_timestamps.csv"
    for name in ("slices", "absent"):
        with pytest.raises(FileNotFoundError):
            readers.only_file(files, name)
    rows_ = spark.createDataFrame([(1, 2, 3)], "frame_id int, tree int, x int")
    assert readers.reconciled(rows_, {"frame_id": "frame", "tree": "x", "gone": "y"}).columns == ["frame", "tree", "x"]
