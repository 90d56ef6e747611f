"""Trackers: detections of one scan, frame by frame, joined into tracks."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .folds import _per_scan
from .geometry import greedy_pairs

_BOX = ["x1", "y1", "x2", "y2"]


CLOSE, MID, FAR = 0, 1, 2


@dataclass(frozen=True)
class WindowTracker:
    """Search windows follow the camera's shift; scores weigh shape, distance and depth over the sum of all four weights.

    `reach` is how far a window goes to the side that the shift leads to, and to the other, for boxes that are close, mid and far. A scene is close if the
    mean of its ten least depths is at most `close_depth`; boxes are then classed by area (`areas`: below the first far, below the second mid), in
    other scenes all are mid. While under `uncoupled_most` of the last detections stayed without a track, windows follow the mean shift of their class instead of the frame's.
    Distances are measured against the frame's width, or, if `adaptive`, against twice the shift, `least_distance` at least.
    """

    width: int = 1536
    height: int = 2048
    reach: tuple[tuple[float, float], ...] = ((2.2, 1.2), (1.5, 0.8), (1.2, 0.4))
    close_depth: float = 0.9
    areas: tuple[float, float] = (250.0, 400.0)
    margin: float = 5.0
    match: str = "inter"
    det_area: float = 1.0
    weights: tuple[float, float, float, float] = (1.0, 1.0, 0.0, 0.0)
    uncoupled_most: float = 0.8
    adaptive: bool = False
    least_distance: float = 10.0
    max_losses: int = 10
    history: int = 10
    samples: int = 5
    stale_most: int = 5


#: A row for each track. `depth` is nan where it is not known; `bare`: the track began in a frame without any depth, and has had none since.
_TRACK = np.dtype([("number", int), ("box", float, 4), ("depth", float), ("bare", bool), ("kind", int), ("count", int), ("lost", int), ("move", float)])


class ClassShifts:
    """The latest mean shifts of each class; a class that has not had enough samples for too long starts anew."""

    def __init__(self, p: WindowTracker):
        self.p, self.means, self.stale = p, [deque(maxlen=p.history) for _ in range(3)], [0, 0, 0]

    def learn(self, tracks: np.ndarray) -> None:
        telling = tracks[(tracks["count"] > 3) & (tracks["lost"] == 0)]
        for kind, means in enumerate(self.means):
            last = telling["move"][telling["kind"] == kind]
            if len(last) >= self.p.samples:
                means.append(float(np.mean(last)))
                self.stale[kind] = 0
            else:
                self.stale[kind] += 1
            if self.stale[kind] > self.p.stale_most:
                means.clear()

    def settled(self, kind: int) -> bool:
        return len(self.means[kind]) > 5

    def of(self, kind: int) -> float:
        """Of a class without samples, the mid class's."""
        return float(np.mean(self.means[kind] or self.means[MID]))


def box_kinds(boxes: np.ndarray, det_depth: np.ndarray | None, p: WindowTracker) -> np.ndarray:
    """The class of each track's box in a scene with these depths."""
    known = np.sort(det_depth[~np.isnan(det_depth)])[:10] if det_depth is not None else np.zeros(0)
    if not len(known) or known.mean() > p.close_depth:
        return np.full(len(boxes), MID)
    size = _sizes(boxes)
    return np.where(size < p.areas[0], FAR, np.where(size < p.areas[1], MID, CLOSE))


def windows_of(boxes: np.ndarray, tx: np.ndarray, ty: np.ndarray, kinds: np.ndarray, p: WindowTracker) -> np.ndarray:
    """Where each box may be found next: far on the side that its shift leads to, a little on the other."""
    reach = np.array(p.reach)[kinds]

    def side(low, high, shift, most):
        far, near = shift * reach[:, 0], shift * reach[:, 1]
        ahead = far > 0
        low, high = np.where(ahead, low - far, low - (near + p.margin)), np.where(ahead, high - (near - p.margin), high - far)
        return np.maximum(low, 0), np.minimum(high, most)

    x1, x2 = side(boxes[:, 0], boxes[:, 2], tx, p.width)
    y1, y2 = side(boxes[:, 1], boxes[:, 3], ty, p.height)
    return np.stack([x1, y1, x2, y2], axis=1)


def _common_sides(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w = np.minimum(a[:, None, 2], b[None, :, 2]) - np.maximum(a[:, None, 0], b[None, :, 0])
    return w, np.minimum(a[:, None, 3], b[None, :, 3]) - np.maximum(a[:, None, 1], b[None, :, 1])


def overlaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    w, h = _common_sides(a, b)
    return np.maximum(w, 0) * np.maximum(h, 0)


def _sizes(b: np.ndarray) -> np.ndarray:
    return (b[:, 2] - b[:, 0]) * (b[:, 3] - b[:, 1])


def windows_meet(windows: np.ndarray, dets: np.ndarray, p: WindowTracker) -> np.ndarray:
    """Windows x detections: whether the detection (shrunk to `det_area` of its sides), or the pixel at its centre, has a pixel in the window; edge pixels count."""
    if p.match == "center":
        centre = (dets[:, :2] + dets[:, 2:]) / 2
        seen = np.concatenate([centre, centre + 1], axis=1)
    elif p.match == "inter":
        inset = (1 - p.det_area) / 2 * np.stack([dets[:, 2] - dets[:, 0], dets[:, 3] - dets[:, 1]], axis=1)
        seen = np.concatenate([dets[:, :2] + inset, dets[:, 2:] - inset], axis=1)
    else:
        raise ValueError(f"no way of matching is called {p.match}")
    w, h = _common_sides(windows, seen)
    return (w + 1 > 0) & (h + 1 > 0)


def match_scores(windows: np.ndarray, boxes: np.ndarray, dets: np.ndarray, track_depth: np.ndarray, det_depth: np.ndarray | None, most: float, p: WindowTracker) -> np.ndarray:
    """Scores of tracks x detections; 0 where the detection does not meet the window. Unknown depths count half, and so do all if their differences are equal."""
    ratio = _sizes(boxes)[:, None] / np.maximum(_sizes(dets)[None, :], 1e-9)
    shape = np.minimum(ratio, 1 / np.maximum(ratio, 1e-9))
    centre = lambda b: (b[:, :2] + b[:, 2:]) / 2
    far = np.sqrt(((centre(windows)[:, None] - centre(dets)[None]) ** 2).sum(axis=2))
    total = shape * p.weights[0] + (1 - np.minimum(far / most, 1)) * p.weights[1]
    if det_depth is not None and p.weights[2]:
        gap = np.abs(track_depth[:, None] - det_depth[None, :])
        known = gap[~np.isnan(gap)]
        spread = known.max() - known.min() if len(known) else 0.0
        total = total + p.weights[2] * (1 - np.nan_to_num(gap / spread, nan=0.5) if spread > 0 else np.full_like(gap, 0.5))
    return np.where(windows_meet(windows, dets, p), total / sum(p.weights), 0.0)


def track_scan(pdf: pd.DataFrame, p: WindowTracker) -> pd.DataFrame:
    """(frame, pos, track_id) of one scan's detections (frame, pos, box, depth, tx, ty), in frame order.

    A frame without a shift moves no window, and lost tracks go on by the last known one. After a shift of over a third of the width nothing is
    followed. A track is lost for good at its `max_losses`-th miss or when it has left the frame.
    """
    tracks = np.zeros(0, _TRACK)
    shifts, uncoupled, last_tx, last_ty, number, out = ClassShifts(p), 1.0, 0.0, 0.0, 0, []
    for frame, pos, dets, depth, txs, tys in _frames(pdf, "depth", "tx", "ty"):
        tx, ty = txs[0], tys[0]
        last_tx, last_ty = last_tx if np.isnan(tx) else float(tx), last_ty if np.isnan(ty) else float(ty)
        tx, ty = 0.0 if np.isnan(tx) else float(tx), 0.0 if np.isnan(ty) else float(ty)
        most = max(2 * abs(last_tx), p.least_distance) if p.adaptive else p.width
        if max(abs(last_tx), abs(last_ty)) > p.width // 3:  # everything has moved out of reach
            tracks, last_tx, last_ty = tracks[:0], 0.0, 0.0
        bare = bool(np.isnan(depth).all())
        free, missed = np.ones(len(dets), bool), np.ones(len(tracks), bool)
        if len(tracks):
            kinds, shift = np.full(len(tracks), MID), np.full(len(tracks), tx)
            if not tracks["bare"].any():
                kinds = box_kinds(tracks["box"], None if bare else depth, p)
                if shifts.settled(MID) and uncoupled < p.uncoupled_most:
                    shift = np.array([shifts.of(k) for k in range(3)])[kinds]
            windows = windows_of(tracks["box"], shift, np.full(len(tracks), ty), kinds, p)
            pairs = greedy_pairs(match_scores(windows, tracks["box"], dets, tracks["depth"], None if bare else depth, most, p))
            if pairs:
                r, c = np.array(pairs).T
                tracks["move"][r] = tracks["box"][r, 0] - dets[c, 0]
                tracks["box"][r], tracks["lost"][r], tracks["kind"][r] = dets[c], 0, kinds[r]
                tracks["count"][r] += 1
                known = ~np.isnan(depth[c])
                tracks["depth"][r[known]], tracks["bare"][r[known]] = depth[c[known]], False
                free[c], missed[r] = False, False
                out.append((np.full(len(r), frame), pos[c], tracks["number"][r]))
        uncoupled = int(free.sum()) / len(dets)
        shifts.learn(tracks)
        if missed.any():
            step = np.array([shifts.of(k) if shifts.settled(k) else last_tx for k in range(3)])[tracks["kind"]]
            tracks["lost"] += missed
            tracks["box"][:, 0::2] -= np.where(missed, step, 0.0)[:, None]
            seen = (np.trunc(tracks["box"][:, 2]) > 0) & (np.trunc(tracks["box"][:, 0]) < p.width)
            tracks = tracks[~missed | (tracks["lost"] < p.max_losses) & seen]
        begun = np.zeros(int(free.sum()), _TRACK)
        begun["number"], begun["box"], begun["depth"], begun["bare"] = number + np.arange(len(begun)), dets[free], depth[free], bare
        begun["kind"], begun["count"] = MID, 1
        tracks, number = np.concatenate([tracks, begun]), number + len(begun)
        out.append((np.full(len(begun), frame), pos[free], begun["number"]))
    columns = [np.concatenate(c) for c in zip(*out)] if out else [[], [], []]
    return pd.DataFrame(dict(zip(["frame", "pos", "track_id"], columns)))


def _frames(pdf: pd.DataFrame, *figures: str):
    """(frame, pos, boxes, each of the figures) of each frame of a scan, in order, as arrays."""
    pdf = pdf[pdf["frame"].notna()].sort_values(["frame", "pos", *_BOX])
    frame, pos, dets = pdf["frame"].to_numpy(), pdf["pos"].to_numpy(), pdf[_BOX].to_numpy(float)
    more = [pdf[c].to_numpy(float) for c in figures]
    cuts = [0, *(np.flatnonzero(frame[1:] != frame[:-1]) + 1).tolist(), len(frame)]
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            yield frame[a], pos[a:b], dets[a:b], *(m[a:b] for m in more)


def window_tracks(detections: DataFrame, by: list[str], params: WindowTracker = WindowTracker()) -> DataFrame:
    """(by, frame, pos, track_id) for each detection (by, frame, pos, x1, y1, x2, y2, depth, tx, ty)."""
    return _tracked(detections.select(*by, "frame", "pos", *_BOX, "depth", "tx", "ty"), by, lambda pdf: track_scan(pdf, params))


def _tracked(detections: DataFrame, by: list[str], scan: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    tasks = int(detections.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a number of our own, as trackers cost more than their bytes tell
    return _per_scan(detections.repartition(tasks, *by), by, "frame long, pos long, track_id long", scan)


@dataclass(frozen=True)
class TwoStageTracker:
    """Strong detections are matched first, weak ones to what is left, then what is still left to tracks seen only once; lost tracks wait `buffer` frames.

    `fused`: overlaps with strong detections are multiplied by their scores. `alike`: a tracked and a lost track nearer than this are one. `gated`:
    a detection that a track's motion makes unlikely (beyond the 95th percentile of its squared Mahalanobis distance) is none of its options, and of costs the
    share `looks` is that of the boxes, the rest that distance; by the centre alone if `centre_only`.
    """

    strong: float = 0.6
    weak: float = 0.1
    first_most: float = 0.8
    second_most: float = 0.5
    buffer: int = 30
    unconfirmed_most: float = 0.7
    alike: float = 0.15
    fused: bool = True
    gated: bool = False
    looks: float = 0.98
    centre_only: bool = False


#: The 0.95 quantiles of the chi-square distribution with 2 and 4 degrees of freedom.
GATES = {2: 5.9915, 4: 9.4877}


def _variances(at: float, aspect: float, speed: float, aspect_speed: float):
    """Of noise in the figures and their speeds: parts of the height, but fixed for the aspect."""
    parts, fixed = np.array([at, at, np.inf, at, speed, speed, np.inf, speed]), np.array([0, 0, aspect, 0, 0, 0, aspect_speed, 0])
    return lambda means: (means[..., 3:4] / parts + fixed) ** 2


def _coupled(covs: np.ndarray) -> np.ndarray:
    """A view (…, 2, 2, 4) of covariances (…, 8, 8): of each figure the variances of itself and of its speed, and what they share."""
    return np.einsum("...aibi->...abi", covs.reshape(*covs.shape[:-2], 2, 4, 2, 4))


class ConstantVelocity:
    """A Kalman filter over (centre x, centre y, aspect, height) and their speeds; noise is in proportion to the height.

    Of one track or, with more axes before, of many at once: means (…, 8), covariances (…, 8, 8). No figure tells anything of another: in a covariance only
    the diagonal and what a figure and its own speed share are not zero, and stay so, so that all is worked out figure by figure.
    """

    first, moving, seen = (staticmethod(_variances(*v)) for v in ((10, 1e-2, 16, 1e-5), (20, 1e-2, 160, 1e-5), (20, 1e-1, 20, 1e-1)))

    def begin(self, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([m, np.zeros(m.shape)], axis=-1), self.first(m)[..., None] * np.eye(8)

    def predict(self, means: np.ndarray, covs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        noise, out = self.moving(means), np.zeros(covs.shape)
        old, new = _coupled(covs), _coupled(out)
        new[..., 0, 1, :] = new[..., 1, 0, :] = both = old[..., 0, 1, :] + old[..., 1, 1, :]
        new[..., 0, 0, :] = (old[..., 0, 0, :] + old[..., 0, 1, :]) + both + noise[..., :4]
        new[..., 1, 1, :] = old[..., 1, 1, :] + noise[..., 4:]
        return np.concatenate([means[..., :4] + means[..., 4:], means[..., 4:]], axis=-1), out

    def _inner(self, means: np.ndarray, covs: np.ndarray) -> np.ndarray:
        """Variances of what is measured."""
        return _coupled(covs)[..., 0, 0, :] + self.seen(means)[..., :4]

    def distances(self, means: np.ndarray, covs: np.ndarray, measured: np.ndarray, centre_only: bool = False) -> np.ndarray:
        """Squared Mahalanobis distances of tracks x measurements (m, 4)."""
        k = 2 if centre_only else 4
        apart = measured[None, :, :k] - means[:, None, :k]
        return (apart**2 / self._inner(means, covs)[:, None, :k]).sum(axis=2)

    def update(self, means: np.ndarray, covs: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        inner, out = self._inner(means, covs), covs.copy()
        gain = _coupled(covs)[..., 0, :, :] / inner[..., None, :]  # of the figures and of their speeds
        new = _coupled(out)
        new -= (gain * inner[..., None, :])[..., :, None, :] * gain[..., None, :, :]
        return means + (gain * (m - means[..., :4])[..., None, :]).reshape(means.shape), out


def _measured(b: np.ndarray) -> np.ndarray:
    """Of one box or of many at once."""
    out, low, high = np.empty(b.shape), b[..., :2], b[..., 2:]
    out[..., :2] = (low + high) / 2
    out[..., 3] = np.maximum(b[..., 3] - b[..., 1], 1e-6)
    out[..., 2] = (b[..., 2] - b[..., 0]) / out[..., 3]
    return out


def _boxed(means: np.ndarray) -> np.ndarray:
    """Of many means at once."""
    out, half = np.empty((len(means), 4)), np.empty((len(means), 2))
    half[:, 0], half[:, 1] = means[:, 2] * means[:, 3], means[:, 3]
    half /= 2
    out[:, :2], out[:, 2:] = means[:, :2] - half, means[:, :2] + half
    return out


def assignment(cost: np.ndarray, most: float) -> list[tuple[int, int]]:
    """The pairs of least total cost, where leaving a row or column alone costs `most` / 2 each.

    Only pairs up to `most` can be in it, so that rows and columns that such pairs do not tie together are settled apart.
    """
    allowed, out = cost <= most, []
    free = set(np.flatnonzero(allowed.any(axis=1)).tolist())
    while free:
        rows, columns, grow = {free.pop()}, set(), True
        while grow:
            columns = set(np.flatnonzero(allowed[sorted(rows)].any(axis=0)).tolist())
            more = set(np.flatnonzero(allowed[:, sorted(columns)].any(axis=1)).tolist())
            grow, rows = len(more) > len(rows), rows | more
        free -= rows
        r, c = sorted(rows), sorted(columns)
        out += [(r[i], c[j]) for i, j in _hungarian(cost[np.ix_(r, c)], most)]
    return sorted(out)


def _hungarian(cost: np.ndarray, most: float) -> list[tuple[int, int]]:
    """The Hungarian method with potentials, on a square of both sides and their stand-ins for staying alone."""
    n, m = cost.shape
    if n == m == 1:
        return [(0, 0)]
    size = n + m
    full = np.full((size, size), most / 2)
    full[:n, :m] = cost
    full[n:, m:] = 0
    u, v, way_of = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1, int)
    for row in range(1, size + 1):
        way_of[0], column = row, 0
        least, back, used = np.full(size + 1, np.inf), np.zeros(size + 1, int), np.zeros(size + 1, bool)
        while way_of[column]:
            used[column] = True
            reduced = full[way_of[column] - 1] - u[way_of[column]] - v[1:]
            better = ~used[1:] & (reduced < least[1:])
            least[1:][better], back[1:][better] = reduced[better], column
            following = int(np.where(used[1:], np.inf, least[1:]).argmin()) + 1
            delta = least[following]
            u[way_of[used]] += delta
            v[used] -= delta
            least[~used] -= delta
            column = following
        while column:
            way_of[column] = way_of[back[column]]
            column = back[column]
    return sorted((int(way_of[c]) - 1, c - 1) for c in range(1, m + 1) if 1 <= way_of[c] <= n and cost[way_of[c] - 1, c - 1] <= most)


def two_stage_scan(pdf: pd.DataFrame, p: TwoStageTracker) -> pd.DataFrame:
    """(frame, pos, track_id) of the matched detections of one scan (frame, pos, box, score).

    A track begun after the first frame is reported from its second match on, and goes if the next frame has none for it.
    Of a tracked and a lost track in one place, the one seen over more frames stays, else the lost one.
    """
    kalman, number, out, first, tracks = ConstantVelocity(), 0, [], None, None

    def distance(boxes, others):
        common = overlaps(boxes, others)
        return 1 - common / np.maximum(_sizes(boxes)[:, None] + _sizes(others)[None] - common, 1e-9)

    for frame, pos, dets, score in _frames(pdf, "score"):
        if tracks is None:  # a row for each track
            time = pdf["frame"].to_numpy().dtype
            first, tracks = frame, np.zeros(0, [("number", int), ("mean", float, 8), ("cov", float, (8, 8)), ("start", time), ("seen", time), ("pos", pos.dtype), ("sure", bool), ("lost", bool)])
        measured = _measured(dets)
        sure = np.flatnonzero(tracks["sure"])
        if len(sure):
            tracks["mean"][sure], tracks["cov"][sure] = kalman.predict(tracks["mean"][sure], tracks["cov"][sure])
        strong, weak = np.flatnonzero(score > p.strong), np.flatnonzero((score <= p.strong) & (score > p.weak))
        apart = distance(_boxed(tracks["mean"]), dets)  # a track moves when it is matched, and is then not asked for again

        def matched(own, part, most, fused):
            """Pairs found are taken into the tracks; the detections without one are returned."""
            if not len(own) or not len(part):
                return part
            cost = apart[own[:, None], part]
            cost = 1 - (1 - cost) * score[part] if fused else cost
            cost = p.looks * cost if p.gated else cost
            if not (cost <= most).any():  # motion only adds to it
                return part
            mean, cov = tracks["mean"][own], tracks["cov"][own]
            if p.gated:
                moved = kalman.distances(mean, cov, measured[part], p.centre_only)
                cost = np.where(moved > GATES[2 if p.centre_only else 4], np.inf, cost + (1 - p.looks) * moved)
            pairs = assignment(cost, most)
            if not pairs:
                return part
            r, c = np.array(pairs).T
            t, d = own[r], part[c]
            tracks["mean"][t], tracks["cov"][t] = kalman.update(mean[r], cov[r], measured[d])
            tracks["seen"][t], tracks["pos"][t], tracks["sure"][t], tracks["lost"][t] = frame, pos[d], True, False
            return np.delete(part, c)

        once = np.flatnonzero(~tracks["sure"])
        left = matched(sure, strong, p.first_most, p.fused)
        matched(sure[~tracks["lost"][sure] & (tracks["seen"][sure] != frame)], weak, p.second_most, False)
        left = matched(once, left, p.unconfirmed_most, p.fused)
        kept = tracks[(frame - tracks["seen"] <= p.buffer) & (tracks["sure"] | (tracks["seen"] == frame))]
        tracks = np.zeros(len(kept) + len(left), tracks.dtype)
        tracks[: len(kept)], begun = kept, tracks[len(kept) :]
        begun["number"], (begun["mean"], begun["cov"]) = number + np.arange(len(left)), kalman.begin(measured[left])
        begun["start"], begun["seen"], begun["pos"], begun["sure"] = frame, frame, pos[left], frame == first
        number += len(left)
        tracks["lost"] = tracks["seen"] != frame
        here, lost = np.flatnonzero(~tracks["lost"]), np.flatnonzero(tracks["lost"])
        if len(here) and len(lost):
            a, b = np.nonzero(distance(_boxed(tracks["mean"][here]), _boxed(tracks["mean"][lost])) < p.alike)
            if len(a):
                a, b, age = here[a], lost[b], tracks["seen"] - tracks["start"]
                tracks = np.delete(tracks, np.where(age[a] > age[b], b, a))
        told = tracks["sure"] & ~tracks["lost"]
        out.append((np.full(int(told.sum()), frame), tracks["pos"][told], tracks["number"][told]))
    columns = [np.concatenate(c) for c in zip(*out)] if out else [[], [], []]
    return pd.DataFrame(dict(zip(["frame", "pos", "track_id"], columns)))


def two_stage_tracks(detections: DataFrame, by: list[str], params: TwoStageTracker = TwoStageTracker()) -> DataFrame:
    """(by, frame, pos, track_id) for the detections (by, frame, pos, x1, y1, x2, y2, score) of confirmed tracks."""
    return _tracked(detections.select(*by, "frame", "pos", *_BOX, "score"), by, lambda pdf: two_stage_scan(pdf, params))
