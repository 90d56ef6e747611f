"""Folds over many groups at once: cut batches, near pairs, suppression."""

import numpy as np
import pyarrow as pa

from fieldloom.operators import folds, geometry, grouped, measuring


def test_groups_are_whole_however_batches_cut_them():
    keys = [None, None, 0, 0, 0, 0, 0, 1, 2, 2]
    for size in (1, 2, 3, 10):
        whole = pa.record_batch({"k": pa.array(keys), "n": pa.array(range(10))})
        got = []
        for table, groups in grouped._whole_groups((whole.slice(i, size) for i in range(0, 10, size)), ["k"]):
            assert groups[0] == 0 and set(np.diff(groups)) <= {0, 1}
            got += [table.column("k").take(pa.array(np.flatnonzero(groups == g))).to_pylist() for g in range(groups[-1] + 1)]
        assert got == [[None, None], [0] * 5, [1], [2, 2]]


def test_near_pairs_of_large_groups_stay_few():
    low = np.arange(50_000, dtype=float)
    i, j = grouped.near_pairs(np.zeros(50_000, int), low, low + 1.5, lambda i, j: np.ones(len(i), bool))  # all pairs would be 10 GB
    assert sorted(np.minimum(i, j).tolist()) == list(range(49_999)) and (np.abs(i - j) == 1).all()


def test_suppression_takes_many_groups_a_call(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(int(k % 400), int(k), *map(int, b), *(int(v) for v in b + rng.integers(1, 30, 2)), float(s)) for k, (b, s) in enumerate(zip(rng.integers(0, 60, (8000, 2)), rng.integers(0, 9, 8000)))]
    df = spark.createDataFrame(rows, "frame long, pos long, x1 long, y1 long, x2 long, y2 long, score double")
    with monkeypatch.context() as m:  # a call for each group does not scale with their number
        m.setattr(type(df.groupBy("frame")), "applyInPandas", None, raising=False)
        got = {r.pos for r in geometry.non_maximum_suppression(df, ["frame"], 0.3).collect()}
    want = set()
    for f in range(400):
        left = []
        for r in sorted((r for r in rows if r[0] == f), key=lambda r: (-r[6], r[1])):
            area = lambda b: (b[4] - b[2]) * (b[5] - b[3])
            common = lambda a, b: max(min(a[4], b[4]) - max(a[2], b[2]), 0) * max(min(a[5], b[5]) - max(a[3], b[3]), 0)
            if not any(common(r, b) > 0.3 * (area(r) + area(b) - common(r, b)) for b in left):
                left.append(r)
        want |= {r[1] for r in left}
    assert got == want and len(want) < 8000


def test_clusters_take_many_groups_a_call(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(int(k % 300), int(9000 - k), *map(float, b), *map(float, b + 10)) for k, b in enumerate(rng.integers(0, 100, (6000, 2)))]
    rows += [(0, 9001, float("nan"), 1.0, 2.0, 2.0), (300, 9002, float("nan"), 1.0, 2.0, 2.0), (300, 9003, 1.0, 1.0, 2.0, 2.0), (300, 9004, 9.0, 1.0, 10.0, 2.0)]
    df = spark.createDataFrame(rows, "frame long, pos long, x1 double, y1 double, x2 double, y2 double")
    with monkeypatch.context() as m:
        m.setattr(type(df.groupBy("frame")), "applyInPandas", None, raising=False)
        got = sorted(tuple(r) for r in folds.greedy_clusters(df, ["frame"], 9.0).collect())
    want = []
    for f in range(301):
        own, clusters = sorted((r for r in rows if r[0] == f), key=lambda r: r[1]), []
        centre = {r[1]: ((r[2] + r[4]) / 2, (r[3] + r[5]) / 2) for r in own}
        for r in own:
            around = {p for p, c in centre.items() if np.hypot(c[0] - centre[r[1]][0], c[1] - centre[r[1]][1]) < 9.0}
            home = next((c for c in clusters if c & around), None)
            clusters.append(around) if home is None else home.update(around)
        want += sorted((f, p, c) for p, c in {p: c for c, members in enumerate(clusters) for p in members}.items())
    assert got == want and want[-2:] == [(300, 9003, 1), (300, 9004, 1)]


def test_greedy_hits_meet_without_a_join(spark):
    rng, limits = np.random.default_rng(7), [0.1, 0.3, 0.5]
    boxes = [(k % 40, int(c), k, *map(int, b), *map(int, b + s), float(v)) for k, (c, b, s, v) in enumerate(zip(rng.integers(0, 2, 2400), rng.integers(0, 60, (2400, 2)), rng.integers(8, 30, (2400, 2)), rng.integers(0, 9, 2400)))]
    df = spark.createDataFrame([*boxes, (0, None, 9000, 1, 1, 9, 9, 1.0), (0, None, 9001, 1, 1, 9, 9, 1.0)], "frame long, class long, pos long, x1 long, y1 long, x2 long, y2 long, score double")
    truth, found = df.where("(pos div 40) % 2 = 0"), df.where("(pos div 40) % 2 = 1")
    states = measuring.greedy_states(truth, found, ["frame"], limits, most=12)
    assert "Join" not in states._jdf.queryExecution().executedPlan().toString()
    got = sorted((r.frame, r["class"], r.pos, r.threshold, r.hit) for r in measuring.greedy_hits(truth, found, ["frame"], limits, most=12).where("class is not null").collect())
    want = []
    area = lambda b: (b[5] - b[3]) * (b[6] - b[4])
    for f, c in {b[:2] for b in boxes}:
        own = [b for b in boxes if b[:2] == (f, c)]
        ranked = sorted((b for b in own if b[2] // 40 % 2), key=lambda b: (-b[7], b[2]))[:12]
        for t in limits:
            taken = set()
            for b in ranked:
                common = {g[2]: max(min(b[5], g[5]) - max(b[3], g[3]), 0) * max(min(b[6], g[6]) - max(b[4], g[4]), 0) / 1.0 for g in own if g[2] // 40 % 2 == 0}
                shares = {g[2]: common[g[2]] / (area(b) + area(g) - common[g[2]]) for g in own if g[2] in common}
                best = min(((-s, p) for p, s in shares.items() if s >= t and p not in taken), default=None)
                taken |= {best[1]} if best else set()
                want.append((f, c, b[2], t, int(best is not None)))
    assert got == sorted(want) and 100 < sum(w[4] for w in want) < len(want)
    assert measuring.greedy_precision(truth, found, ["frame"], limits).count() == 6
