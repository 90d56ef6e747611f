"""Evaluation of boxes by area class, with crowds and limits for an image, and identity measures of tracks by the best assignment."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import written
from .grouped import fold_groups, near_pairs, numbers, ranked
from .scans import curve_figures, precision_curve, recall_points

#: The usual area classes, in pixels, both bounds included.
AREAS = {"all": (0.0, 1e10), "small": (0.0, 1024.0), "medium": (1024.0, 9216.0), "large": (9216.0, 1e10)}
#: The usual overlaps, 0.5 to 0.95.
OVERLAPS = [round(0.5 + 0.05 * k, 2) for k in range(10)]


def optimal_pairs(gain: np.ndarray) -> list[tuple[int, int]]:
    """(row, column) pairs of the greatest total gain, as many as the shorter side has; shortest augmenting paths over prices."""
    if gain.shape[0] > gain.shape[1]:
        return sorted((r, c) for c, r in optimal_pairs(gain.T))
    cost, (n, m) = -np.asarray(gain, float), gain.shape
    row_price, column_price = np.zeros(n), np.zeros(m + 1)
    owner = np.full(m + 1, -1)
    for r in range(n):
        owner[m], at = r, m
        least, came, done = np.full(m, np.inf), np.full(m, m), np.zeros(m + 1, bool)
        while owner[at] >= 0:
            done[at] = True
            open_ = ~done[:m]
            reduced = cost[owner[at]] - row_price[owner[at]] - column_price[:m]
            better = open_ & (reduced < least)
            least[better], came[better] = reduced[better], at
            step_to = int(np.argmin(np.where(open_, least, np.inf)))
            step = least[step_to]
            row_price[owner[done]] += step
            column_price[done] -= step
            least[open_] -= step
            at = step_to
        while at != m:
            owner[at], at = owner[came[at]], came[at]
    return sorted((int(owner[c]), c) for c in range(m) if owner[c] >= 0)


def most_pairs(gain: dict) -> dict:
    """left to right of as many of the pairs {(left, right): gain} as can be, with the greatest total gain; gains are in [0, 1], and no side is used twice.

    Only pairs that share a side, directly or by others, are settled together.
    """
    rights, lefts, out, seen = defaultdict(list), defaultdict(list), {}, set()
    for a, b in gain:
        rights[a].append(b)
        lefts[b].append(a)
    for a, own in rights.items():
        if len(own) == 1 and len(lefts[own[0]]) == 1:
            out[a] = own[0]
            continue
        if a in seen:
            continue
        tied, open_ = {a}, [a]
        while open_:
            for b in rights[open_.pop()]:
                more = [c for c in lefts[b] if c not in tied]
                tied.update(more)
                open_ += more
        seen |= tied
        rows, columns = sorted(tied), sorted({b for c in tied for b in rights[c]})
        n = sum(len(rights[c]) for c in rows)
        # A pair counts for more than any sum of gains, so that the number of pairs comes first.
        table = np.array([[n + 1 + gain[r, c] if (r, c) in gain else 0.0 for c in columns] for r in rows])
        out |= {rows[r]: columns[c] for r, c in optimal_pairs(table) if table[r, c] > 0}
    return out


#: Sides of `sided_pairs`.
TRUE, FOUND, IGNORED = 0, 1, 2
_BOX = ["x1", "y1", "x2", "y2"]


def _side(boxes: DataFrame, by: list[str], side: int, name: str | None) -> DataFrame:
    """`boxes` as rows of `sided_pairs`; boxes of which no place is asked may have no pos."""
    pos = F.col("pos") if "pos" in boxes.columns else F.lit(None)
    identity = F.lit(None) if name is None else F.col(name)
    return boxes.select(*by, F.lit(side).alias("side"), identity.cast("double").alias("id"), pos.cast("long").alias("pos"), *(F.col(c).cast("double").alias(c) for c in _BOX))


def _shared(table: pa.Table, by: list[str], groups: np.ndarray, side: np.ndarray, limits: list[float], corners: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, iou) of the rows i of another side and j found of one group whose overlap reaches the limit of i's side. Rows with a null in `by` meet none."""
    x1, y1, x2, y2 = (numbers(table, c).astype(float) for c in corners)
    known = np.logical_and.reduce([table.column(c).is_valid().to_numpy() for c in by])
    x1, size = np.where(known, x1, np.nan), (x2 - x1) * (y2 - y1)

    def overlap(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        common = np.clip(np.minimum(x2[i], x2[j]) - np.maximum(x1[i], x1[j]), 0, None) * np.clip(np.minimum(y2[i], y2[j]) - np.maximum(y1[i], y1[j]), 0, None)
        with np.errstate(divide="ignore", invalid="ignore"):
            return common / (size[i] + size[j] - common)

    least = np.array(limits)

    def test(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        hit = (side[i] == FOUND) != (side[j] == FOUND)
        i, j = i[hit], j[hit]
        hit[hit] = overlap(i, j) >= least[np.where(side[i] == FOUND, side[j], side[i])]
        return hit

    i, j = near_pairs(groups, x1, x2, test)
    i, j = np.where(side[i] == FOUND, j, i), np.where(side[i] == FOUND, i, j)
    return i, j, overlap(i, j)


def _codes(*columns: np.ndarray) -> np.ndarray:
    """A number for each row, the same for rows that agree, in their order."""
    return np.unique(np.stack(columns, axis=1), axis=0, return_inverse=True)[1].reshape(-1)


def _gone(groups: np.ndarray, pos: np.ndarray, side: np.ndarray, i: np.ndarray, j: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Which rows are found boxes that a box to be ignored is assigned to."""
    place, gain = _codes(groups, pos), {}
    for a, b, v in zip(place[i].tolist(), place[j].tolist(), shared.tolist()):
        gain[a, b] = max(v, gain.get((a, b), 0.0))
    return (side == FOUND) & np.isin(place, list(most_pairs(gain).values()))


def sided_pairs(boxes: DataFrame, by: list[str], least_iou: float, ignored_iou: float = 0.5) -> DataFrame:
    """`track_pairs` of one table of boxes (by, side, id, pos, x1, y1, x2, y2) of the sides TRUE, FOUND and IGNORED, after `without_ignored`.

    Boxes are shuffled once, and a call takes many frames.
    """
    kinds = dict(boxes.dtypes)

    def fold(table: pa.Table, groups: np.ndarray) -> pa.Table:
        side, ids = numbers(table, "side"), table.column("id").combine_chunks()
        i, j, shared = _shared(table, by, groups, side, [least_iou, 0.0, ignored_iou], _BOX)
        kept = side != IGNORED
        drop = side[i] == IGNORED
        if drop.any():
            gone = _gone(groups, numbers(table, "pos"), side, i[drop], j[drop], shared[drop])
            kept &= ~gone
        stays = ~drop & kept[j]
        i, j, shared = i[stays], j[stays], shared[stays]
        true, found = np.flatnonzero(kept & (side == TRUE)), np.flatnonzero(kept & (side == FOUND))
        none = lambda n: pa.nulls(n, pa.float64())
        take = lambda rows: ids.take(pa.array(rows))
        out = table.select(by).take(pa.array(np.concatenate([i, true, found])))
        out = out.append_column("gt_id", pa.chunked_array([take(i), take(true), none(len(found))]))
        out = out.append_column("trk_id", pa.chunked_array([take(j), none(len(true)), take(found)]))
        return out.append_column("iou", pa.array(np.concatenate([shared, np.zeros(len(true) + len(found))])))

    return fold_groups(boxes, by, fold, ", ".join(f"{c} {kinds[c]}" for c in by) + ", gt_id double, trk_id double, iou double")


def track_pairs(truth: DataFrame, found: DataFrame, by: list[str], least_iou: float) -> DataFrame:
    """(by, gt_id, trk_id, iou) for `mot_summary` and `identity_summary`: the boxes that overlap enough, and each box once without a partner.

    `by` ends in the frame. Ids are numbers.
    """
    return sided_pairs(_side(truth, by, TRUE, "gt_id").union(_side(found, by, FOUND, "trk_id")), by, least_iou)


def without_ignored(found: DataFrame, ignored: DataFrame, by: list[str], least_iou: float = 0.5) -> DataFrame:
    """The found boxes that no box to be ignored is assigned to; `by` ends in the frame, both sides have pos, x1, y1, x2, y2.

    Within a frame, as many pairs with an overlap of at least `least_iou` are formed as can be, with the greatest total overlap. Boxes are shuffled once, and
    a call takes many frames.
    """
    own = [f"__{c}" for c in ("side", "pos", *_BOX)]
    plain = lambda boxes, side, keep: boxes.select(*keep, F.lit(side).alias("__side"), F.col("pos").cast("long").alias("__pos"), *(F.col(c).cast("double").alias(f"__{c}") for c in _BOX))
    rows = plain(found, FOUND, found.columns).unionByName(plain(ignored, IGNORED, by), allowMissingColumns=True)

    def fold(table: pa.Table, groups: np.ndarray) -> pa.Table:
        side = numbers(table, "__side")
        gone = _gone(groups, numbers(table, "__pos"), side, *_shared(table, by, groups, side, [0.0, 0.0, least_iou], own[2:]))
        return table.drop_columns(own).filter(pa.array((side == FOUND) & ~gone))

    return fold_groups(rows, by, fold, rows.drop(*own).schema)


def identity_summary(pairs: DataFrame, by: list[str], least_iou: float, overall: bool = False) -> DataFrame:
    """(by, idtp, idp, idr, idf1): each true identity has one track at most for its whole scan, so that most boxes agree; with `overall`, a row more
    whose `by` is null has the same of the summed counts.

    Pairs are shuffled once, by scan, and a call takes many scans; what is assigned is a table of the identities and tracks of one scan that ever met.
    """
    kinds = dict(pairs.dtypes)

    def fold(table: pa.Table, groups: np.ndarray) -> pa.Table:
        frame, gt, trk = (ranked(table, c) for c in ("frame", "gt_id", "trk_id"))
        heads = np.searchsorted(groups, np.arange(groups[-1] + 1))
        once = lambda rows, *columns: np.unique(np.stack([c[rows] for c in columns], axis=1), axis=0)
        n_true, n_found = (np.bincount(once((frame >= 0) & (c >= 0), groups, frame, c)[:, 0], minlength=len(heads)) for c in (gt, trk))
        met = once((frame >= 0) & (gt >= 0) & (trk >= 0) & (numbers(table, "iou") >= least_iou), groups, gt, trk, frame)
        both, n = np.unique(met[:, :3], axis=0, return_counts=True)
        idtp, cuts = np.zeros(len(heads), int), np.searchsorted(both[:, 0], np.arange(len(heads) + 1))
        for k in np.flatnonzero(np.diff(cuts)):
            own = slice(cuts[k], cuts[k + 1])
            (true, r), (tracks, c) = (np.unique(both[own, side], return_inverse=True) for side in (1, 2))
            together = np.zeros((len(true), len(tracks)))
            together[r, c] = n[own]
            idtp[k] = sum(together[p] for p in optimal_pairs(together))
        out = table.select(by).take(pa.array(heads))
        for name, figure in (("n_true", n_true), ("n_found", n_found), ("idtp", idtp)):
            out = out.append_column(name, pa.array(figure.astype(np.int64)))
        return out

    out = fold_groups(pairs.select(*by, "frame", "gt_id", "trk_id", "iou"), by, fold, ", ".join(f"{k} {kinds[k]}" for k in by) + ", n_true long, n_found long, idtp long")
    if overall:
        out = written(out, "counts")
        sums = out.agg(*(F.sum(c).alias(c) for c in ("n_true", "n_found", "idtp"))).where("n_true is not null")
        out = out.unionByName(sums.select(*(F.lit(None).cast(kinds[c]).alias(c) for c in by), "*"))
    share = lambda n: F.try_divide(F.col("idtp"), n)
    return out.select(*by, "idtp", share(F.col("n_found")).alias("idp"), share(F.col("n_true")).alias("idr"), F.try_divide(2.0 * F.col("idtp"), F.col("n_true") + F.col("n_found")).alias("idf1"))


def _image_states(truth: np.ndarray, found: np.ndarray, thresholds: list[float], bounds: list[tuple[float, float]]) -> np.ndarray:
    """(area class, found box, threshold) of 1 for a hit, 0 for a miss and -1 for what does not count.

    Rows are x1, y1, x2, y2, area, crowd; found boxes come by falling score. A found box takes the free true box that it overlaps most, one that
    counts before one that does not; a crowd is never used up, and its overlap is the covered share of the found box.
    """
    low, high = np.maximum(found[:, None, :2], truth[None, :, :2]), np.minimum(found[:, None, 2:4], truth[None, :, 2:4])
    common = np.clip(high - low, 0, None).prod(axis=2)
    size = lambda b: (b[:, 2] - b[:, 0]) * (b[:, 3] - b[:, 1])
    crowd = truth[:, 5] > 0
    whole = np.where(crowd[None, :], size(found)[:, None], size(found)[:, None] + size(truth)[None, :] - common)
    overlap = common / np.maximum(whole, 1e-12)
    limits = np.minimum(np.array(thresholds, float), 1 - 1e-10)
    outside = lambda b: np.array([(b[:, 4] < lo) | (b[:, 4] > hi) for lo, hi in bounds])
    idle = crowd | outside(truth)
    states = np.repeat(-outside(found).astype(int)[:, :, None], len(limits), axis=2)
    taken = np.zeros((len(bounds), len(limits), len(truth)), bool)
    # All areas and thresholds at once; a found box looks only at the true boxes that it overlaps enough for any of them.
    for d, near in enumerate(overlap >= limits.min()):
        near = np.flatnonzero(near)
        if not len(near):
            continue
        own = overlap[d, near]
        fits = (own >= limits[:, None]) & (crowd[near] | ~taken[:, :, near])
        counting = fits & ~idle[:, None, near]
        choice = np.where(counting.any(axis=2, keepdims=True), counting, fits)
        last = len(near) - 1 - np.argmax(np.where(choice, own, -1.0)[:, :, ::-1], axis=2)
        a, t = np.nonzero(choice.any(axis=2))
        best = near[last[a, t]]
        taken[a, t, best] = True
        states[a, d, t] = np.where(idle[a, best], -1, 1)
    return states


def _with_area(boxes: DataFrame) -> Column:
    return (F.col("area") if "area" in boxes.columns else (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))).cast("double")


def matched_states(truth: DataFrame, found: DataFrame, by: list[str], thresholds: list[float] | None = None, areas: dict | None = None, most: int = 100) -> DataFrame:
    """(by, class, pos, score, rank, counts, hits) of the found boxes; bit `area * number of thresholds + threshold` of `counts` and `hits` (long) is for that cell.

    Boxes have by, class, pos, x1, y1, x2, y2; found ones a score; true ones may have `crowd` (0/1), and both an `area` that stands for that of the box; `by` names the
    image. Of an image and class, the `most` best scores take part (ties by pos) and `rank` counts them from 1. Boxes are shuffled once; a call takes many images.
    """
    thresholds, areas = thresholds or OVERLAPS, areas or AREAS
    bounds, cells = list(areas.values()), len(thresholds) * len(areas)
    if cells > 63:
        raise ValueError("at most 63 cells of an area and a threshold have a bit")
    crowd = F.coalesce(F.col("crowd").cast("double"), F.lit(0.0)) if "crowd" in truth.columns else F.lit(0.0)
    corners = [F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")]
    key, figures = [*by, "class"], ["x1", "y1", "x2", "y2", "area", "crowd"]
    side = lambda boxes, true, score, crowd: boxes.select(*key, "pos", *corners, _with_area(boxes).alias("area"), crowd.alias("crowd"), score.alias("score"), F.lit(true).alias("true"))
    rows = side(truth, True, F.lit(None).cast("double"), crowd).unionByName(side(found, False, F.col("score").cast("double"), F.lit(0.0)))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    bits = 1 << np.arange(cells, dtype=np.int64)

    def fold(table, groups):
        b = np.stack([numbers(table, c).astype(float) for c in figures], axis=1)
        pos, score, true = (numbers(table, c) for c in ("pos", "score", "true"))
        order = np.lexsort((pos, np.where(true, 0, -score), ~true.astype(bool), groups))  # of each image the true boxes, then the found ones
        cuts = [0, *(np.flatnonzero(np.diff(groups[order])) + 1).tolist(), len(order)]
        n_true = np.add.reduceat(true[order].astype(int), cuts[:-1]).tolist()
        rows, ranks, counts, hits = [], [], [], []
        for start, end, n in zip(cuts, cuts[1:], n_true):
            best = order[start + n : min(end, start + n + most)]
            if not len(best):
                continue
            own = _image_states(b[order[start : start + n]], b[best], thresholds, bounds).transpose(1, 0, 2).reshape(len(best), cells)
            rows.append(best)
            ranks.append(np.arange(1, len(best) + 1, dtype=np.int32))
            counts.append((own >= 0) @ bits)
            hits.append((own > 0) @ bits)
        joined = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts])
        out = table.select([*key, "pos", "score"]).take(joined(rows, np.int64))
        return out.append_column("rank", pa.array(joined(ranks, np.int32))).append_column("counts", pa.array(joined(counts, np.int64))).append_column("hits", pa.array(joined(hits, np.int64)))

    return fold_groups(rows, key, fold, ", ".join(f"{c} {kinds[c]}" for c in (*key, "pos")) + ", score double, rank int, counts long, hits long")


def matched_boxes(truth: DataFrame, found: DataFrame, by: list[str], thresholds: list[float] | None = None, areas: dict | None = None, most: int = 100) -> DataFrame:
    """(by, class, pos, score, rank, area_class, threshold, hit) of the found boxes that count, a row for each area class and threshold; see `matched_states`."""
    thresholds, areas = thresholds or OVERLAPS, areas or AREAS
    named = [(n, t) for n in areas for t in thresholds]
    steps = F.array(*(F.struct(F.lit(n).alias("area_class"), F.lit(t).alias("threshold"), F.lit(1 << k).cast("long").alias("bit")) for k, (n, t) in enumerate(named)))
    each = matched_states(truth, found, by, thresholds, areas, most).withColumn("step", F.explode(steps)).where(F.col("counts").bitwiseAND(F.col("step.bit")) != 0)
    return each.select(*by, "class", "pos", "score", "rank", "step.area_class", "step.threshold", (F.col("hits").bitwiseAND(F.col("step.bit")) != 0).cast("int").alias("hit"))


def _true_counts(truth: DataFrame, areas: dict) -> DataFrame:
    """(class, counts): the true boxes of each area class that are no crowds."""
    area = _with_area(truth)
    counted = truth if "crowd" not in truth.columns else truth.where("coalesce(crowd, 0) = 0")
    within = F.array(*(F.count(F.when(area.between(lo, hi), 1)) for lo, hi in areas.values()))
    return counted.where("class is not null").groupBy("class").agg(within.alias("counts"))


def evaluated_cells(truth: DataFrame, found: DataFrame, by: list[str], thresholds: list[float] | None = None, areas: dict | None = None, limits: tuple[int, ...] = (1, 10, 100), points: int = 101) -> DataFrame:
    """The figures of `area_cells` from the boxes themselves. A found box is one row for all area classes and thresholds."""
    thresholds, areas = thresholds or OVERLAPS, areas or AREAS
    named = [(n, t) for n in areas for t in thresholds]
    n_true = written(_true_counts(truth, areas), "true")
    spread = F.flatten(F.transform("counts", lambda n: F.array_repeat(n, len(thresholds))))
    order = [F.col("score").desc(), *(F.col(c) for c in (*by, "pos"))]
    figures = curve_figures(matched_states(truth, found, by, thresholds, areas), ["class"], order, n_true.select("class", spread.alias("n_true")), len(named), points, limits)
    cells = n_true.select("class", F.posexplode(spread).alias("cell", "n_true")).where("n_true > 0")
    names = F.array(*(F.struct(F.lit(n).alias("area_class"), F.lit(t).alias("threshold")) for n, t in named))
    filled = cells.join(figures, ["class", "cell"], "left").withColumn("of", F.get(names, F.col("cell")))
    return filled.select("class", "of.area_class", "of.threshold", F.coalesce("ap", F.lit(0.0)).alias("ap"), *(F.coalesce(F.col(f"hits_{m}") / F.col("n_true"), F.lit(0.0)).alias(f"recall_{m}") for m in limits))


def area_cells(matches: DataFrame, truth: DataFrame, by: list[str], thresholds: list[float] | None = None, areas: dict | None = None, limits: tuple[int, ...] = (1, 10, 100), points: int = 101) -> DataFrame:
    """(class, area_class, threshold, ap, recall_N for each limit N of boxes an image) of the classes and areas that have true boxes."""
    thresholds, areas = thresholds or OVERLAPS, areas or AREAS
    area = _with_area(truth)
    counts = truth if "crowd" not in truth.columns else truth.where("coalesce(crowd, 0) = 0")
    held = counts.select("class", F.explode(F.array(*(F.when(area.between(lo, hi), F.lit(n)) for n, (lo, hi) in areas.items()))).alias("area_class")).where("area_class is not null")
    cells = held.groupBy("class", "area_class").agg(F.count("*").alias("n_true")).withColumn("threshold", F.explode(F.array(*map(F.lit, thresholds))))
    key = ["class", "area_class", "threshold"]
    rows = precision_curve(matches.join(cells, key), key, [F.col("score").desc(), *(F.col(c) for c in (*by, "pos"))])
    # A row answers for the recall points above those of the row before and up to its own; the number of points is told in whole numbers.
    answers = recall_points("tp", "n_true", points) - recall_points("(tp - hit)", "n_true", points) + F.when(F.col("n") == 1, 1).otherwise(0)
    figures = rows.groupBy(*key).agg((F.sum(answers * F.col("envelope")) / points).alias("ap"), *(F.sum(F.when(F.col("rank") <= m, F.col("hit")).otherwise(0)).alias(f"hits_{m}") for m in limits))
    filled = cells.join(figures, key, "left")
    return filled.select(*key, F.coalesce("ap", F.lit(0.0)).alias("ap"), *(F.coalesce(F.col(f"hits_{m}") / F.col("n_true"), F.lit(0.0)).alias(f"recall_{m}") for m in limits))


def area_summary(cells: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The twelve usual figures of the cells, for all classes or for each of `by`; -1 where no cell has true boxes."""
    mean = lambda value, when: F.coalesce(F.avg(F.when(when, F.col(value))), F.lit(-1.0))
    of = lambda name: F.col("area_class") == name
    at = lambda t: of("all") & (F.abs(F.col("threshold") - t) < 1e-9)
    figures = {"ap": ("ap", of("all")), "ap_50": ("ap", at(0.5)), "ap_75": ("ap", at(0.75))}
    figures |= {f"ap_{n}": ("ap", of(n)) for n in ("small", "medium", "large")}
    figures |= {f"ar_{m}": (f"recall_{m}", of("all")) for m in (1, 10, 100)}
    figures |= {f"ar_{n}": ("recall_100", of(n)) for n in ("small", "medium", "large")}
    return cells.groupBy(*(by or [])).agg(*(mean(*f).alias(name) for name, f in figures.items()))
