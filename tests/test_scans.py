"""Two-pass scans, matching with difficult boxes, and tracking scores with ignored boxes, against plain loops over whole tables."""

import itertools
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldloom.operators import evaluation, scans, scoring, voc
from fieldloom.plans import scores

SF = "/root/testdata/sf0.001"
IMAGE = ["scan_id", "frame"]


def test_running_figures_of_a_hot_key(spark):
    """One class with nearly all rows is dealt over the tasks, and every figure is that of one ordered pass; nulls are a class of their own."""
    rng = np.random.default_rng(1)
    rows = [(None if k % 50 == 1 else 1 if k % 50 == 2 else 0, float(s), k, int(h)) for k, (s, h) in enumerate(zip(rng.integers(0, 300, 20_000) / 300, rng.random(20_000) < 0.4))]
    df = spark.createDataFrame(rows, "class int, score double, pos int, hit int").repartition(8)
    order = [F.col("score").desc(), F.col("pos")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small parts would be put together
    try:
        ranged = scans.in_ranges(df, ["class"], order)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in ranged.groupBy(scans.PART).count().collect()]
    assert len(sizes) > 2 and max(sizes) < 2 * sum(sizes) / len(sizes)
    got = scans.running_sums(ranged, ["class"], order, {"tp": F.col("hit"), "n": F.lit(1)}).withColumn("p", F.col("tp") / F.col("n"))
    got = {r.pos: (r.tp, r.n, r.best) for r in scans.best_from_here(got, ["class"], [F.col("n").desc()], "p", "best").collect()}
    for kind in (None, 0, 1):
        own = sorted((r for r in rows if r[0] == kind), key=lambda r: (-r[1], r[2]))
        tp = np.cumsum([r[3] for r in own])
        p = tp / np.arange(1, len(own) + 1)
        best = np.maximum.accumulate(p[::-1])[::-1]
        assert all(got[r[2]] == (tp[k], k + 1, best[k]) for k, r in enumerate(own))
    assert scans.average_precision(df.limit(0).withColumn("n_true", F.lit(1)), ["class"], order).count() == 0


BOX = "scan_id int, frame int, class int, pos long, x1 double, y1 double, x2 double, y2 double"


def plain_voc(truth, found, thresholds):
    """(class, threshold) to (n_true, area, eleven points), box by box."""

    def overlap(a, b):
        w, h = min(a[6], b[6]) - max(a[4], b[4]) + 1, min(a[7], b[7]) - max(a[5], b[5]) + 1
        common = max(w, 0) * max(h, 0)
        size = lambda x: (x[6] - x[4] + 1) * (x[7] - x[5] + 1)
        return common / (size(a) + size(b) - common)

    out = {}
    for kind in {t[2] for t in truth if not t[8]}:
        n_true = sum(t[2] == kind and not t[8] for t in truth)
        images = defaultdict(list)
        for t in sorted(truth, key=lambda t: t[3]):
            if t[2] == kind:
                images[t[:2]].append(t)
        for limit in thresholds:
            used, tp, fp, curve = set(), 0, 0, []
            for d in sorted((d for d in found if d[2] == kind), key=lambda d: (-d[8], *d[:2], d[3])):
                overlaps = [overlap(d, t) for t in images[d[:2]]]
                best = int(np.argmax(overlaps)) if overlaps else -1
                if best >= 0 and overlaps[best] > limit:
                    t = images[d[:2]][best]
                    if t[8]:
                        continue
                    hit = (t[:4]) not in used
                    used.add(t[:4])
                else:
                    hit = False
                tp, fp = tp + hit, fp + (not hit)
                curve.append((tp, tp / n_true, tp / (tp + fp)))
            area, before = 0.0, 0.0
            for k, (_, r, _) in enumerate(curve):
                area += (r - before) * max(p for _, _, p in curve[k:])
                before = r
            eleven = sum(max((p for t, _, p in curve if t * 10 >= k * n_true), default=0.0) for k in range(11)) / 11
            out[kind, limit] = n_true, area, eleven
    return out


@pytest.mark.parametrize("seed", range(3))
def test_difficult_boxes_equal_plain_loops(spark, seed):
    """Crowded images, doubled and shifted boxes, equal scores, equal overlaps, classes without found boxes, images without true ones."""
    rng = np.random.default_rng(seed)
    truth, found = [], []
    for k in range(160):
        x, y, w = rng.integers(0, 60), rng.integers(0, 60), rng.integers(8, 30)
        row = (int(k % 2), int(k % 7), int(k % 4), k, float(x), float(y), float(x + w), float(y + w))
        if k % 9:
            truth.append((*row, int(k % 5 == 0)))
        for n in range(int(rng.integers(0, 4))):
            if row[2] < 3:
                dx = float(rng.integers(-3, 4))
                found.append((*row[:3], 1000 + 10 * k + n, row[4] + dx, row[5], row[6] + dx, row[7], float(rng.integers(0, 8)) / 8))
    thresholds = [0.1, 0.5, 0.75]
    want = plain_voc(truth, found, thresholds)
    sides = spark.createDataFrame(truth, BOX + ", difficult int"), spark.createDataFrame(found, BOX + ", score double")
    for eleven in (False, True):
        got = {(r["class"], r.threshold): (r.n_true, r.ap) for r in voc.precisions(*sides, IMAGE, thresholds, eleven).collect()}
        assert got.keys() == want.keys()
        assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1 + eleven]) < 1e-12 for k in want)
    assert voc.precisions(sides[0].limit(0), sides[1], IMAGE).count() == 0


def test_difficult_boxes_by_hand(spark):
    """Two found boxes on one true box, one on a difficult box, one nearest to a used box though another would be free."""
    truth = spark.createDataFrame([(0, 0, 1, 1, 0.0, 0.0, 9.0, 9.0, 0), (0, 0, 1, 2, 100.0, 0.0, 109.0, 9.0, 1), (0, 0, 1, 3, 3.0, 0.0, 12.0, 9.0, 0)], BOX + ", difficult int")
    found = spark.createDataFrame([(0, 0, 1, 1, 0.0, 0.0, 9.0, 9.0, 0.9), (0, 0, 1, 2, 1.0, 0.0, 10.0, 9.0, 0.8), (0, 0, 1, 3, 100.0, 0.0, 109.0, 9.0, 0.95)], BOX + ", score double")
    assert sorted((r.pos, r.hit) for r in voc.matches(truth, found, IMAGE, [0.5]).collect()) == [(1, 1), (2, 0)]
    assert voc.precisions(truth, found, IMAGE, [0.5]).first().ap == 0.5


def best_pairs(options):
    """As many pairs as can be, then the greatest total, by trying all; options that touch are settled together."""
    out, left = {}, dict(options)
    while left:
        part, grow = {next(iter(left))}, True
        while grow:
            more = {o for o in left if any(o[0] == p[0] or o[1] == p[1] for p in part)}
            grow, part = len(more) > len(part), part | more
        best = (0, 0.0, ())
        for n in range(1, len(part) + 1):
            for chosen in itertools.combinations(sorted(part), n):
                if len({a for a, _ in chosen}) == len({b for _, b in chosen}) == n:
                    best = max(best, (n, sum(left[c] for c in chosen), chosen))
        out |= dict(best[2])
        left = {o: v for o, v in left.items() if o not in part}
    return out


def plain_mot(truth, found, ignored, limit):
    """scan to (matches, misses, false positives, switches), frame by frame."""

    def overlap(a, b):
        w, h = min(a.x2, b.x2) - max(a.x1, b.x1), min(a.y2, b.y2) - max(a.y1, b.y1)
        common = max(w, 0) * max(h, 0)
        return common / ((a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) - common)

    by = lambda rows: {k: list(g) for k, g in itertools.groupby(sorted(rows, key=lambda r: (r.scan_id, r.frame, r.pos)), key=lambda r: (r.scan_id, r.frame))}
    truth, found, ignored = by(truth), by(found), by(ignored)
    out, last = defaultdict(lambda: [0, 0, 0, 0]), defaultdict(dict)
    for key in sorted(truth.keys() | found.keys()):
        own, seen = truth.get(key, []), found.get(key, [])
        gone = best_pairs({(a.pos, b.pos): overlap(a, b) for a in ignored.get(key, []) for b in seen if overlap(a, b) >= limit}).values()
        seen = [b for b in seen if b.pos not in set(gone)]
        options = {(a.gt_id, b.trk_id): overlap(a, b) for a in own for b in seen if overlap(a, b) >= limit}
        taken = {g: t for g, t in last[key[0]].items() if (g, t) in options}
        taken |= best_pairs({(g, t): v for (g, t), v in options.items() if g not in taken and t not in set(taken.values())})
        mine = out[key[0]]
        mine[0] += len(taken)
        mine[1] += len({a.gt_id for a in own}) - len(taken)
        mine[2] += len({b.trk_id for b in seen}) - len(taken)
        mine[3] += sum(g in last[key[0]] and last[key[0]][g] != t for g, t in taken.items())
        last[key[0]] |= taken
    return out


def test_ignored_boxes_over_a_whole_table(spark):
    truth, ignored, found = scores._tracks(spark, SF)
    want = plain_mot(truth.collect(), found.collect(), ignored.collect(), 0.5)
    got = {r.scan_id: r for r in scores.QUERIES["mot_ignored"][0](spark, SF).collect()}
    assert {k: [r.matches, r.misses, r.false_positives, r.switches] for k, r in got.items() if k is not None} == want
    total = [sum(v[k] for v in want.values()) for k in range(4)]
    whole = got[None]
    assert [whole.matches, whole.misses, whole.false_positives, whole.switches] == total
    assert abs(whole.mota - (1 - sum(total[1:]) / (total[0] + total[1]))) < 1e-12 and abs(whole.precision - total[0] / (total[0] + total[2])) < 1e-12
    without = evaluation.mot_summary(scoring.track_pairs(truth, found, IMAGE, 0.5), ["scan_id"], 0.5)
    assert sum(r.false_positives for r in without.collect()) > total[2]
    ids = {r.scan_id: r for r in scores.QUERIES["identity_ignored"][0](spark, SF).collect()}
    assert ids[None].idtp == sum(r.idtp for k, r in ids.items() if k is not None)


def test_ignoring_takes_as_many_pairs_as_can_be(spark):
    """The best overlap alone would leave a found box in place."""
    box = "scan_id int, frame int, pos int, x1 int, y1 int, x2 int, y2 int"
    ignored = spark.createDataFrame([(0, 1, 1, 0, 0, 100, 10), (0, 1, 2, 30, 0, 130, 10)], box)
    found = spark.createDataFrame([(0, 1, 7, 10, 0, 110, 10), (0, 1, 8, 0, 0, 70, 10), (0, 1, 9, 500, 0, 600, 10)], box)
    assert [r.pos for r in scoring.without_ignored(found, ignored, IMAGE).collect()] == [9]
    assert scoring.without_ignored(found, ignored.limit(0), IMAGE).count() == 3
