"""Assignments against all permutations, identities by hand, areas and crowds against a plain walk over boxes."""

import itertools
import math

import numpy as np
import pytest

from fieldloom.operators import evaluation, scoring

BOX = "scan_id int, frame int, class int, pos long, x1 int, y1 int, x2 int, y2 int, score double, crowd int"
IMAGE = ["scan_id", "frame"]


def test_optimal_pairs_equal_the_best_permutation():
    rng = np.random.default_rng(3)
    for _ in range(60):
        n, m = rng.integers(1, 6, 2)
        gain = rng.integers(0, 9, (n, m)).astype(float)
        got = scoring.optimal_pairs(gain)
        wide = gain if n <= m else gain.T
        best = max(sum(wide[r, c] for r, c in enumerate(p)) for p in itertools.permutations(range(wide.shape[1]), wide.shape[0]))
        assert math.isclose(sum(gain[p] for p in got), best)
        assert len(got) == min(n, m) == len({r for r, _ in got}) == len({c for _, c in got})


PAIRS = "scan_id int, frame int, gt_id double, trk_id double, iou double"


def test_identities_are_assigned_over_the_scan(spark):
    """Object 1 is track 7 for two frames, then 8 for three; 8 was object 2 for one frame, which is track 9 otherwise."""
    met = [(0, f, 1.0, 7.0 if f < 2 else 8.0, 0.9) for f in range(5)] + [(0, 0, 2.0, 8.0, 0.8)] + [(0, f, 2.0, 9.0, 0.8) for f in range(1, 4)] + [(0, 4, 2.0, 9.0, 0.1)]
    rows = met + [(0, 5, 3.0, None, 0.0), (1, 0, None, 4.0, 0.0)]
    got = {r.scan_id: r for r in scoring.identity_summary(spark.createDataFrame(rows, PAIRS), ["scan_id"], 0.5).collect()}
    assert got[0].idtp == 6 and math.isclose(got[0].idr, 6 / 11) and math.isclose(got[0].idp, 6 / 10) and math.isclose(got[0].idf1, 12 / 21)
    assert got[1].idtp == 0 and got[1].idr is None and got[1].idf1 == 0.0
    assert scoring.identity_summary(spark.createDataFrame([], PAIRS), ["scan_id"], 0.5).count() == 0


def test_as_many_boxes_are_paired_as_can_be(spark):
    """The best overlap alone would leave one box of each side over."""
    rows = [(0, 1, 1.0, 7.0, 0.9), (0, 1, 1.0, 8.0, 0.6), (0, 1, 2.0, 7.0, 0.6)]
    got = evaluation.mot_summary(spark.createDataFrame(rows, PAIRS), ["scan_id"], 0.5).first()
    assert (got.matches, got.misses, got.false_positives, got.precision, got.recall) == (2, 0, 0, 1.0, 1.0)


def test_track_pairs_name_each_box(spark):
    truth = spark.createDataFrame([(0, 1, 1, 1.0, 0, 0, 10, 10), (0, 1, 2, 2.0, 500, 500, 520, 520)], "scan_id int, frame int, pos int, gt_id double, x1 int, y1 int, x2 int, y2 int")
    found = truth.withColumnRenamed("gt_id", "trk_id").where("pos = 1")
    got = sorted(map(str, ((r.gt_id, r.trk_id, r.iou) for r in scoring.track_pairs(truth, found, IMAGE, 0.5).collect())))
    assert got == sorted(map(str, [(1.0, 1.0, 1.0), (1.0, None, 0.0), (2.0, None, 0.0), (None, 1.0, 0.0)]))


def plain_cells(truth, found, thresholds, limits):
    """All figures by loops: (class, area, threshold) to (ap, recalls)."""

    def area(b):
        return (b[6] - b[4]) * (b[7] - b[5])

    def overlap(d, g):
        w, h = min(d[6], g[6]) - max(d[4], g[4]), min(d[7], g[7]) - max(d[5], g[5])
        common = max(w, 0) * max(h, 0)
        return common / (area(d) if g[9] else area(d) + area(g) - common)

    out = {}
    for kind, (name, (lo, hi)), t in itertools.product(sorted({b[2] for b in truth}), scoring.AREAS.items(), thresholds):
        counts = lambda g: not g[9] and lo <= area(g) <= hi
        n_true = sum(counts(g) for g in truth if g[2] == kind)
        if not n_true:
            continue
        seen = []
        for image in {b[:2] for b in found}:
            used = set()
            ranked = sorted((b for b in found if b[:2] == image and b[2] == kind), key=lambda b: (-b[8], b[3]))
            for rank, d in enumerate(ranked[: max(limits)], 1):
                options = [(counts(g), overlap(d, g), g[3], g) for g in truth if g[:2] == image and g[2] == kind and overlap(d, g) >= t and (g[9] or g[3] not in used)]
                if options:
                    own = max(options, key=lambda o: o[:3])
                    used.add(own[2])
                    if own[0]:
                        seen.append((-d[8], image, d[3], rank, 1))
                elif lo <= area(d) <= hi:
                    seen.append((-d[8], image, d[3], rank, 0))
        seen.sort()
        tp = np.cumsum([s[4] for s in seen])
        curve = [(c / n_true, c / (k + 1)) for k, c in enumerate(tp)]
        ap = sum(max((p for r, p in curve if r * 100 >= k - 1e-9), default=0.0) for k in range(101)) / 101
        out[kind, name, t] = (ap, *(sum(s[4] for s in seen if s[3] <= m) / n_true for m in limits))
    return out


@pytest.fixture(scope="module")
def scenes():
    rng = np.random.default_rng(8)
    truth, found, pos = [], [], 0
    for frame in range(12):
        for _ in range(int(rng.integers(1, 9))):
            pos += 1
            x, y, w, h = (int(v) for v in (*rng.integers(0, 300, 2), *rng.integers(8, 160, 2)))
            kind = int(rng.integers(0, 2))
            truth.append((0, frame, kind, pos, x, y, x + w, y + h, 0.0, int(rng.random() < 0.15)))
            for copy in range(int(rng.integers(0, 4))):
                dx, dy = (int(v) for v in rng.integers(-8, 9, 2))
                found.append((0, frame, kind, pos * 10 + copy, x + dx, y + dy, x + w + dx, y + h + dy, float(rng.integers(0, 12)) / 10, 0))
    found.append((0, 99, 0, 9999, 0, 0, 50, 50, 0.95, 0))
    return truth, found


def test_cells_equal_a_plain_walk(spark, scenes):
    truth, found = (spark.createDataFrame(rows, BOX) for rows in scenes)
    thresholds, limits = [0.5, 0.75], (1, 3, 100)
    matches = scoring.matched_boxes(truth, found.drop("crowd"), IMAGE, thresholds)
    got = {(r["class"], r.area_class, r.threshold): (r.ap, r.recall_1, r.recall_3, r.recall_100) for r in scoring.area_cells(matches, truth, IMAGE, thresholds, limits=limits).collect()}
    want = plain_cells(*scenes, thresholds, limits)
    assert got.keys() == want.keys() and len(want) > 12
    for key in want:
        assert np.allclose(got[key], want[key]), key


def test_summary_marks_what_has_no_boxes(spark):
    one = spark.createDataFrame([(0, 1, 0, 1, 0, 0, 10, 10, 0.5, 0)], BOX)
    matches = scoring.matched_boxes(one, one.drop("crowd"), IMAGE)
    got = scoring.area_summary(scoring.area_cells(matches, one, IMAGE)).first().asDict()
    assert {k for k, v in got.items() if v == -1.0} == {"ap_medium", "ap_large", "ar_medium", "ar_large"}
    assert all(math.isclose(v, 1.0) for v in got.values() if v != -1.0)
    none = one.where("pos < 0")
    cells = scoring.area_cells(scoring.matched_boxes(one, none, IMAGE), one, IMAGE)
    assert {r.ap for r in cells.collect()} == {0.0} and scoring.area_cells(scoring.matched_boxes(none, one, IMAGE), none, IMAGE).count() == 0
