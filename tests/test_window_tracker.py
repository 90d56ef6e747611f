"""The window tracker: sequences worked by hand in which each rule decides about ids, and a plain version over whole scans."""

import math
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest

from fieldloom.operators import tracking
from fieldloom.operators.tracking import WindowTracker, track_scan, window_tracks
from fieldloom.plans import stateful

SF = "/root/testdata/sf0.001"
COLUMNS = ["frame", "pos", "x1", "y1", "x2", "y2", "depth", "tx", "ty"]


def ids(frames, p=WindowTracker()):
    """`frames`: (tx, [(x1, y1, width, depth), ...]) one after another; the track of each box."""
    rows = [(f, 100 * f + k, x, y, x + w, y + w, depth, tx, 0.0) for f, (tx, boxes) in enumerate(frames) for k, (x, y, w, depth) in enumerate(boxes)]
    got = {r.pos: r.track_id for r in track_scan(pd.DataFrame(rows, columns=COLUMNS), p).itertuples()}
    return [[got[100 * f + k] for k in range(len(boxes))] for f, (_, boxes) in enumerate(frames)]


def row_of(x, n=6, w=10, depth=2.0):
    """Boxes that are too far apart in height to be mistaken for each other."""
    return [(x, 100 * k, w, depth) for k in range(n)]


def test_a_shift_of_over_a_third_of_the_width_ends_all_tracks():
    assert ids([(0.0, [(900, 0, 50, 2.0)]), (512.0, [(388, 0, 50, 2.0)])]) == [[0], [0]]
    assert ids([(0.0, [(900, 0, 50, 2.0)]), (513.0, [(387, 0, 50, 2.0)])]) == [[0], [1]]


def test_reach_depends_on_the_class():
    # A box of 400 square pixels in a close scene reaches 2.2 shifts, in others 1.5.
    assert ids([(0.0, [(900, 0, 20, 0.5)]), (200.0, [(500, 0, 20, 0.5)])]) == [[0], [0]]
    assert ids([(0.0, [(900, 0, 20, 2.0)]), (200.0, [(500, 0, 20, 2.0)])]) == [[0], [1]]
    # Small boxes of a close scene reach 1.2 shifts only.
    assert ids([(0.0, [(900, 0, 10, 0.5)]), (200.0, [(620, 0, 10, 0.5)])]) == [[0], [1]]
    assert ids([(0.0, [(900, 0, 10, 2.0)]), (200.0, [(620, 0, 10, 2.0)])]) == [[0], [0]]
    # 300 square pixels are between the two.
    assert ids([(0.0, [(900, 0, 300**0.5, 0.5)]), (200.0, [(620, 0, 300**0.5, 0.5)])]) == [[0], [0]]
    # Without any depth all boxes are mid, and so they are if one track comes from a frame without depth.
    assert ids([(0.0, [(900, 0, 20, None)]), (200.0, [(500, 0, 20, 0.5)])]) == [[0], [1]]


def test_the_ten_nearest_boxes_tell_a_close_scene():
    many = [(100, 100 * k, 20, 0.5) for k in range(1, 11)]
    far = [(1200, 100 * k, 20, 9.0) for k in range(11, 20)]
    moved = [(x - 200, y, w, d) for x, y, w, d in far]
    assert ids([(0.0, [(900, 0, 20, 0.5), *many, *far]), (200.0, [(500, 0, 20, 0.5), *many, *moved])])[1][0] == 0
    assert ids([(0.0, [(900, 0, 20, 0.5), *many[:3], *far]), (200.0, [(500, 0, 20, 0.5), *many[:3], *moved])])[1][0] > 12


def learned(then, p=WindowTracker(), speed=40.0, n=11):
    """A row of boxes at one speed, long enough for a settled mean, and what comes then."""
    return ids([(speed, row_of(1200 - speed * f)) for f in range(n)] + then, p), 1200 - speed * (n - 1)


def test_windows_follow_the_learned_shift():
    _, x = learned([])
    still = [(0.0, row_of(x - 40)), (0.0, row_of(x - 80))]
    got, _ = learned(still)
    assert got[-1] == list(range(6))
    # It is not used where it may not, nor before it is settled: tracks give their shift from the fourth box on, and six means are needed.
    assert learned(still, WindowTracker(uncoupled_most=0.0))[0][-1] != list(range(6))
    assert learned([(0.0, row_of(1200 - 40 * 8))], n=8)[0][-1] != list(range(6))
    assert learned([(0.0, row_of(1200 - 40 * 9))], n=9)[0][-1] == list(range(6))


def test_many_uncoupled_detections_turn_to_the_frames_shift():
    _, x = learned([])
    crowd = [(100 + 50 * k, 1000 + 60 * j, 10, 2.0) for k in range(10) for j in range(3)]
    got, _ = learned([(40.0, row_of(x - 40) + crowd), (0.0, row_of(x - 80))])
    assert not set(got[-1]) & set(range(6))
    got, _ = learned([(40.0, row_of(x - 40) + crowd[:5]), (0.0, row_of(x - 80))])
    assert got[-1] == list(range(6))


def test_histories_go_when_nothing_is_learned():
    _, x = learned([])
    one = [(40.0, [(x - 40 * k, 0, 10, 2.0)]) for k in range(1, 7)]
    # The other tracks count once more, as they were not lost before the frame; then five frames without samples do no harm, the sixth ends the history.
    got, _ = learned([*one, (0.0, [(x - 280, 0, 10, 2.0)])])
    assert got[-1] == [0]
    one.append((40.0, [(x - 280, 0, 10, 2.0)]))
    got, _ = learned([*one, (0.0, [(x - 320, 0, 10, 2.0)])])
    assert got[-1] != [0]


def test_lost_tracks_go_on_by_the_mean_of_their_class():
    _, x = learned([])
    keep = lambda k: [(x - 40 * k, 100 * j, 10, 2.0) for j in range(1, 6)]
    # The first box is hidden for two frames, while the frames claim no shift.
    got, _ = learned([(0.0, keep(1)), (0.0, keep(2)), (0.0, [(x - 120, 0, 10, 2.0), *keep(3)])])
    assert got[-1] == list(range(6))
    # Without a settled mean the last known shift leads on, also where a frame has none.
    few = [(40.0, [(1000, 0, 10, 2.0)]), (40.0, [(960, 0, 10, 2.0)]), (None, [(500, 900, 10, 2.0)]), (None, [(500, 900, 10, 2.0)]), (40.0, [(840, 0, 10, 2.0)])]
    assert ids(few)[-1] == [0]


def test_tracks_end_at_their_last_loss_and_outside_the_frame():
    gap = lambda n: [(0.0, [(700, 0, 50, 2.0)]), *[(0.0, [(100, 900, 50, 2.0)])] * n, (0.0, [(700, 0, 50, 2.0)])]
    p = WindowTracker(max_losses=3)
    assert ids(gap(2), p)[-1] == [0]
    assert ids(gap(3), p)[-1] == [2]
    leaves = lambda x: [(50.0, [(x, 0, 20, 2.0)]), (50.0, [(900, 900, 20, 2.0)]), (-30.0, [(x - 20, 0, 20, 2.0)])]
    assert ids(leaves(60))[-1] == [0]
    assert ids(leaves(30))[-1] == [2]


def test_matching_by_centre_and_by_shrunk_boxes():
    shifted = [(0.0, [(100, 0, 50, 2.0)]), (0.0, [(140, 0, 50, 2.0)])]
    assert ids(shifted)[-1] == [0]
    assert ids(shifted, WindowTracker(match="center"))[-1] == [1]
    assert ids(shifted, WindowTracker(det_area=0.2))[-1] == [1]
    assert ids([(0.0, [(100, 0, 50, 2.0)]), (0.0, [(120, 0, 50, 2.0)])], WindowTracker(match="center"))[-1] == [0]
    with pytest.raises(ValueError):
        ids(shifted, WindowTracker(match="other"))


def test_distance_by_the_frame_or_by_the_shift():
    # One track, two detections: the nearer one has half the size. By the frame's width size decides, by the shift nearness.
    frames = [(0.0, [(500, 0, 40, 2.0)]), (10.0, [(460, 0, 40, 2.0), (488, 0, 34, 2.0)])]
    assert ids(frames)[-1] == [0, 1]
    assert ids(frames, WindowTracker(adaptive=True))[-1] == [1, 0]


def plain(pdf, p):
    """The same rules, one track and one detection at a time."""
    tracks, fresh, ratio, mem, out = [], 0, 1.0, [0.0, 0.0], []
    past, stale = {0: [], 1: [], 2: []}, {0: 0, 1: 0, 2: 0}
    for frame in sorted(set(pdf.frame)):
        rows = sorted(pdf[pdf.frame == frame].to_dict("records"), key=lambda r: (r["pos"], r["x1"], r["y1"], r["x2"], r["y2"]))
        shift = []
        for k, name in enumerate(("tx", "ty")):
            v = rows[0][name]
            if v is not None and not math.isnan(v):
                mem[k] = v
            shift.append(0.0 if v is None or math.isnan(v) else v)
        most = max(2 * abs(mem[0]), p.least_distance) if p.adaptive else p.width
        if abs(mem[0]) > p.width // 3 or abs(mem[1]) > p.width // 3:
            tracks, mem = [], [0.0, 0.0]
        depths = [float("nan") if r["depth"] is None else r["depth"] for r in rows]
        with_depth = any(not math.isnan(d) for d in depths)
        near = sorted(d for d in depths if not math.isnan(d))[:10]
        close = with_depth and sum(near) / len(near) <= p.close_depth
        plainly = any(t["depth"] is None for t in tracks)
        adaptive = not plainly and len(past[1]) > 5 and ratio < p.uncoupled_most
        found = []
        gaps = [abs(t["depth"] - d) for t in tracks for d in depths if t["depth"] is not None and not math.isnan(t["depth"]) and not math.isnan(d)]
        for n, t in enumerate(tracks):
            x1, y1, x2, y2 = t["box"]
            size, kind = (x2 - x1) * (y2 - y1), 1
            if close and not plainly:
                kind = 2 if size < p.areas[0] else 1 if size < p.areas[1] else 0
            t["seen_as"] = kind
            tx = shift[0]
            if adaptive:
                own = past[kind] or past[1]
                tx = sum(own) / len(own)
            far, little = p.reach[kind]
            window = []
            for low, high, s in ((x1, x2, tx), (y1, y2, shift[1])):
                if s * far > 0:
                    window.append((low - s * far, high - (s * little - p.margin)))
                else:
                    window.append((low - (s * little + p.margin), high - s * far))
            (wx1, wx2), (wy1, wy2) = window
            wx1, wy1, wx2, wy2 = max(wx1, 0), max(wy1, 0), min(wx2, p.width), min(wy2, p.height)
            for m, r in enumerate(rows):
                dx, dy = r["x2"] - r["x1"], r["y2"] - r["y1"]
                if min(wx2, r["x2"]) - max(wx1, r["x1"]) + 1 <= 0 or min(wy2, r["y2"]) - max(wy1, r["y1"]) + 1 <= 0:
                    continue
                away = math.hypot((wx1 + wx2) / 2 - (r["x1"] + r["x2"]) / 2, (wy1 + wy2) / 2 - (r["y1"] + r["y2"]) / 2)
                score = min(size / (dx * dy), dx * dy / size) * p.weights[0] + (1 - min(away / most, 1)) * p.weights[1]
                if with_depth:
                    gap = float("nan") if t["depth"] is None else abs(t["depth"] - depths[m])
                    wide = max(gaps) - min(gaps) if gaps else 0.0
                    score += p.weights[2] * (0.5 if math.isnan(gap) or wide == 0 else 1 - gap / wide)
                found.append((-score / sum(p.weights), n, m))
        taken, given = set(), {}
        for score, n, m in sorted(found):
            if score < 0 and n not in given and m not in taken:
                given[n] = m
                taken.add(m)
        for n, m in given.items():
            t, r = tracks[n], rows[m]
            t["moves"].append(t["box"][0] - r["x1"])
            t.update(box=[r["x1"], r["y1"], r["x2"], r["y2"]], count=t["count"] + 1, lost=0, kind=t["seen_as"])
            if not math.isnan(depths[m]):
                t["depth"] = depths[m]
            out.append((frame, r["pos"], t["id"]))
        ratio = (len(rows) - len(taken)) / len(rows)
        for kind in past:
            last = [t["moves"][-1] for t in tracks if t["count"] > 3 and t["lost"] == 0 and t["kind"] == kind]
            stale[kind] = 0 if len(last) > 4 else stale[kind] + 1
            if len(last) > 4:
                past[kind] = [*past[kind], sum(last) / len(last)][-10:]
            if stale[kind] > 5:
                past[kind] = []
        left = []
        for n, t in enumerate(tracks):
            if n not in given:
                t["lost"] += 1
                own = past[t["kind"]]
                by = sum(own) / len(own) if len(own) > 5 else mem[0]
                t["box"][0] -= by
                t["box"][2] -= by
                if t["lost"] >= p.max_losses or int(t["box"][2]) <= 0 or int(t["box"][0]) >= p.width:
                    continue
            left.append(t)
        tracks = left
        for m, r in enumerate(rows):
            if m not in taken:
                tracks.append({"id": fresh, "box": [r["x1"], r["y1"], r["x2"], r["y2"]], "depth": depths[m] if with_depth else None, "count": 1, "lost": 0, "kind": 1, "moves": []})
                out.append((frame, r["pos"], fresh))
                fresh += 1
    return sorted(out)


def test_a_whole_table_agrees_with_the_plain_version(spark):
    p = replace(WindowTracker(), weights=(0.25, 1.0, 0.25, 0.75), max_losses=3)
    detections = stateful._detections(spark, SF)
    whole = detections.toPandas()
    got = window_tracks(detections, ["scan_id"], p).toPandas()
    assert len(got) == len(whole) == 6000
    for scan, rows in whole.groupby("scan_id"):
        mine = got[got.scan_id == scan]
        assert sorted(zip(mine.frame, mine.pos, mine.track_id)) == plain(rows, p)


@pytest.mark.parametrize("seed", range(6))
def test_random_scans_agree_with_the_plain_version(seed):
    """Rows of boxes at their own speeds, some hidden, some without depth, some frames without a shift."""
    rng = np.random.default_rng(seed)
    rows = []
    speed, sizes = rng.uniform(10, 60), rng.uniform(12, 30, 40)
    x, y, depth = rng.uniform(0, 3000, 40), rng.uniform(0, 1900, 40), rng.uniform(0.3, 1.2 if seed % 2 else 4.0, 40)
    for f in range(40):
        tx = None if rng.random() < 0.1 else speed + rng.normal(0, 4)
        for k in np.flatnonzero((x - speed * f > 0) & (x - speed * f < 1500) & (rng.random(40) > 0.15)):
            left = x[k] - speed * f * (1.3 if depth[k] < 0.6 else 1.0)
            rows.append((f, 1000 * f + int(k), left, y[k], left + sizes[k], y[k] + sizes[k], None if rng.random() < 0.1 else float(depth[k]), tx, rng.normal(0, 3) if k == 0 else 0.0))
    pdf = pd.DataFrame(rows, columns=COLUMNS).astype({"depth": float, "tx": float})
    pdf["ty"] = pdf.groupby("frame")["ty"].transform("first")
    p = replace(WindowTracker(), weights=(0.25, 1.0, 0.25, 0.75), adaptive=bool(seed % 3 == 0))
    got = track_scan(pdf, p)
    assert sorted(zip(got.frame, got.pos, got.track_id)) == plain(pdf, p)
    assert got.track_id.nunique() < len(got) / 3


def test_figures_are_told_by_frame_not_by_track(monkeypatch):
    """Shifts of classes and measured boxes are worked out once a frame, however many tracks and boxes there are."""
    rng, calls = np.random.default_rng(6), {"of": 0, "measured": 0}
    corner = rng.uniform(0, 1200, (20 * 60, 2))
    rows = pd.DataFrame({"frame": np.repeat(range(20), 60), "pos": range(1200), "x1": corner[:, 0], "y1": corner[:, 1], "x2": corner[:, 0] + 30, "y2": corner[:, 1] + 30, "depth": 1.0, "score": 0.9, "tx": 25.0, "ty": 0.0})

    def counted(name, of):
        def call(*a):
            calls[name] += 1
            return of(*a)

        return call

    monkeypatch.setattr(tracking.ClassShifts, "of", counted("of", tracking.ClassShifts.of))
    monkeypatch.setattr(tracking, "_measured", counted("measured", tracking._measured))
    assert len(tracking.track_scan(rows, tracking.WindowTracker(uncoupled_most=1.1))) == 1200
    tracking.two_stage_scan(rows, tracking.TwoStageTracker(gated=True))
    assert 0 < calls["of"] <= 6 * 20 and calls["measured"] == 20
