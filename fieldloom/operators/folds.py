"""Folds over one scan in frame order: slice and row state machines, clamped starts, shift hysteresis, clusters.

Each is grouped by scan, so that scans spread over tasks; a scan is a bounded recording of one row.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .grouped import fold_groups, near_pairs, numbers

OPEN = -1
START, END = "start", "end"
#: What a frame's borders say of the current tree and the next: the bounds that each gets.
EMITS = {0: [(0, ())], 1: [(0, (START,))], 2: [(0, (END,))], 3: [(0, (START,)), (1, (END,))], 4: [(0, (END,)), (1, (START,))], 5: [(0, (START, END))], 6: [(0, (END,)), (1, (START,))]}
#: (state before, state): the next tree becomes the current one first.
ADVANCES = {(0, 1), (0, 5), (2, 1), (2, 5), (3, 0), (3, 1), (3, 5), (4, 0), (4, 1), (4, 5), (5, 1), (6, 1)}
#: Nothing is said of any tree.
SILENT = {(2, 0), (5, 0)}
#: A tree would close before it opens.
WRONG = {(0, 3), (0, 6), (2, 3), (3, 4), (4, 3), (5, 3), (6, 3)}
NARROW = 20


def border_state(start: float | None, end: float | None, direction: str) -> int:
    """0 no border, 1 start, 2 end, 3 and 4 a narrow gap (start then end, end then start), 5 a whole tree, 6 end and start apart."""
    has_start, has_end = start is not None and not np.isnan(start), end is not None and not np.isnan(end)
    if not (has_start and has_end):
        return 1 if has_start else 2 if has_end else 0
    forward = end > start if direction == "right" else end < start
    if abs(end - start) < NARROW:
        return 3 if (forward if direction == "right" else not end > start) else 4
    return 5 if forward else 6


def tree_slices(frames: list[tuple[int, float | None, float | None]], direction: str = "right") -> list[tuple[int, int, int, int]]:
    """(frame, tree, start, end) rows from hand-marked borders; a bound that a frame does not show is -1.

    The next tree's rows carry its own number in every transition, and a missing next tree is opened where one is due.
    """
    out, opened, tree, last = [], set(), 0, 0
    for frame, start, end in frames:
        state = border_state(start, end, direction)
        step = (last, state)
        newest = bool(opened) and tree == max(opened)
        if step in WRONG or (state == 2 and last in (0, 3, 5, 6) and not newest):
            raise ValueError(f"frame {frame}: state {state} after {last}")
        silent = step in SILENT or (step in {(0, 0), (2, 2)} and not newest)
        if step in ADVANCES or (step == (4, 2) and not newest):
            tree += 1
        bounds = {START: start, END: end}
        for offset, shown in [] if silent else EMITS[state]:
            opened.add(tree + offset)
            out.append((frame, tree + offset, *(int(bounds[b]) if b in shown else OPEN for b in (START, END))))
        if step == (3, 6):
            tree += 1
        last = state
    return out


def cut_slices(marks: DataFrame, by: list[str], direction: str = "right") -> DataFrame:
    """(by, frame, tree_id, start, end) of each scan from its marked borders (by, frame, start, end)."""
    return _per_scan(marks, by, "frame long, tree_id long, start long, end long", lambda pdf: pd.DataFrame(tree_slices([(int(f), s, e) for f, s, e in zip(pdf["frame"], pdf["start"], pdf["end"])], direction), columns=["frame", "tree_id", "start", "end"]))


def _per_scan(rows: DataFrame, by: list[str], schema: str, fold: Callable[[pd.DataFrame], pd.DataFrame], order: str = "frame") -> DataFrame:
    """A fold over each scan's rows in order."""
    kinds = dict(rows.dtypes)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = fold(pdf.sort_values(order, kind="stable"))
        for c in by:
            out[c] = pdf[c].iloc[0]
        return out[[*by, *(c for c in out.columns if c not in by)]]

    return rows.groupBy(*by).applyInPandas(run, ", ".join(f"{c} {kinds[c]}" for c in by) + ", " + schema)


def automatic_slices(points: DataFrame, by: list[str]) -> DataFrame:
    """(by, frame, tree_id, start, end) from zero, one or two cut points a frame (column `cuts`): one cut parts two trees, two hold one."""

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        out, tree, last, opened = [], 0, 0, False
        for frame, cuts in zip(pdf["frame"], pdf["cuts"]):
            n = len(cuts)
            if n == 0 and (last == 2 or (last == 0 and not opened)):
                tree += last == 2
                if last == 2:
                    out.append((frame, tree, OPEN, OPEN))
            elif n == 0:
                out.append((frame, tree, OPEN, OPEN))
            elif n == 1:
                out += [(frame, tree, OPEN, cuts[0]), (frame, tree + 1, cuts[0], OPEN)]
                opened = True
            else:
                tree += last in (0, 1)
                out.append((frame, tree, cuts[0], cuts[1]))
                opened = True
            last = n
        return pd.DataFrame(out, columns=["frame", "tree_id", "start", "end"])

    return _per_scan(points, by, "frame long, tree_id long, start long, end long", fold)


def smoothed_cuts(points: DataFrame, by: list[str], near: float = 300) -> DataFrame:
    """A cut seen two frames back and now, but not between, is put in between at their middle; at most two cuts a frame. Earlier repairs count for later ones."""

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        cuts = {int(f): [int(x) for x in c] for f, c in zip(pdf["frame"], pdf["cuts"])}
        for f in sorted(cuts):
            if f - 1 not in cuts or f - 2 not in cuts or len(cuts[f - 1]) == 2:
                continue
            middle = cuts[f - 1]
            for now in cuts[f]:
                for back in cuts[f - 2]:
                    at = (now + back) // 2
                    if len(middle) < 2 and abs(now - back) < near and (not middle or abs(middle[0] - at) > near):
                        middle = sorted([*middle, at])
            cuts[f - 1] = middle
        return pd.DataFrame({"frame": list(cuts), "cuts": list(cuts.values())})

    return _per_scan(points, by, "frame long, cuts array<long>", fold)


def clamped_starts(rows: DataFrame, by: list[str], first: int, width: int) -> DataFrame:
    """`start` of each frame of a tree: from `first`, less the frame's tx, kept within 1 and `width`; once at 1 it stays open."""

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        starts, at = [], first
        for k, tx in enumerate(pdf["tx"]):
            if at == 1:
                starts.append(OPEN)
                continue
            at = at if k == 0 else int(max(1, min(at - tx, width)))
            starts.append(at)
        return pd.DataFrame({"frame": pdf["frame"].to_numpy(), "start": starts})

    return _per_scan(rows, by, "frame long, start long", fold)


def ends_from_next(slices: DataFrame, by: list[str]) -> DataFrame:
    """A slice ends before the next one of its frame starts; the last keeps its end."""
    from pyspark.sql.window import Window

    following = F.lead("start").over(Window.partitionBy(*by, "frame").orderBy("tree_id"))
    return slices.withColumn("end", F.coalesce(following - 1, F.col("end")))


def shift_steps(rows: DataFrame, by: list[str], low: float = 20, high: float = 120, patience: int = 5, decay: bool = True) -> DataFrame:
    """`zed_shift` after each frame: over `patience` frames of small (large) tx move it down (up). Other frames count back by one (`decay`) or to nothing."""

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        shift = less = more = 0
        out = []
        for tx in pdf["tx"]:
            if tx is not None and not np.isnan(tx):
                small, large = tx < low, tx > high
                if decay:
                    less = less + 1 if small else less if large else max(less - 1, 0)
                    more = more if small else more + 1 if large else max(more - 1, 0)
                else:
                    less, more = (less + 1 if small else 0), (more + 1 if large else 0)
                if more > patience:
                    shift, less, more = shift + 1, 0, 0
                if less > patience:
                    shift, less, more = shift - 1, 0, 0
            out.append(shift)
        return pd.DataFrame({"frame": pdf["frame"].to_numpy(), "zed_shift": out})

    return _per_scan(rows, by, "frame long, zed_shift long", fold)


#: Row states, and from each the condition that leads on.
NOT_IN_ROW, STARTING, MIDDLE, ENDING = 0, 1, 2, 3


def row_states(samples: DataFrame, by: list[str], order: str, depth_most: float = 0.3, turn_most: float = 10.0, alpha: float = 0.02) -> DataFrame:
    """(by, order, state, row_number) of a drive through rows, from (depth, turn, in_inner, in_entry, in_heading).

    depth and turn are smoothed with `alpha` from 0.5 and 0. in_entry and in_heading are null while the rows' heading is unknown:
    a row is then entered by depth, turn and inner polygon, and left by the polygon; else by depth and heading, and by the entry areas.
    """

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        depth, turn, state, number, out = 0.5, 0.0, NOT_IN_ROW, 0, []
        for row in pdf.itertuples():
            depth, turn = alpha * row.depth + (1 - alpha) * depth, alpha * row.turn + (1 - alpha) * turn
            deep, straight = depth <= depth_most, abs(turn) < turn_most
            known = row.in_entry is not None and not pd.isna(row.in_entry)
            inside = not row.in_entry if known else bool(row.in_inner)
            heading = row.in_heading is not None and not pd.isna(row.in_heading)
            if state == NOT_IN_ROW:
                if deep and (bool(row.in_heading) if heading else straight and bool(row.in_inner)):
                    state, number = STARTING, number + 1
            elif state == STARTING:
                state = MIDDLE if inside else STARTING
            elif state == MIDDLE:
                state = MIDDLE if inside else ENDING
            else:
                state = MIDDLE if inside else NOT_IN_ROW if not straight else ENDING
            out.append((state, number))
        return pd.DataFrame({order: pdf[order].to_numpy(), "state": [s for s, _ in out], "row_number": [n for _, n in out]})

    return _per_scan(samples, by, f"{order} {dict(samples.dtypes)[order]}, state int, row_number int", fold, order)


def greedy_clusters(boxes: DataFrame, by: list[str], near: float) -> DataFrame:
    """(by, pos, cluster): a box joins the first cluster that holds one of its neighbours and brings all of them; clusters are not closed under that.

    Many groups are folded in a call. Of a box only the first and the last cluster that hold it are kept; neighbours are found along x, so that work follows what is near.
    """
    kinds = dict(boxes.dtypes)

    def fold(table: pa.Table, groups: np.ndarray) -> pa.Table:
        order = np.lexsort((numbers(table, "pos"), groups))
        table, groups = table.take(order), groups[order]
        x, y, pos = (numbers(table, c) for c in ("cx", "cy", "pos"))
        fresh = np.r_[True, (np.diff(groups) != 0) | (np.diff(pos) != 0)]  # rows of one number are one member
        member, rows = fresh.cumsum() - 1, np.arange(len(pos))
        close = lambda i, j: np.hypot(x[i] - x[j], y[i] - y[j]) < near
        i, j = near_pairs(groups, x, x + near * (1 + 1e-9) + np.abs(x) * 1e-12, close)
        own = rows[close(rows, rows)]
        i, j = np.concatenate([own, i, j]), np.concatenate([own, j, i])
        around = member[j[np.argsort(i, kind="stable")]].tolist()
        ends = np.bincount(i, minlength=len(pos)).cumsum().tolist()
        first, last, start, group, clusters = [-1] * (int(member[-1]) + 1), [-1] * (int(member[-1]) + 1), 0, -1, 0
        for g, end in zip(groups.tolist(), ends):
            if g != group:
                group, clusters = g, 0
            mine, start = around[start:end], end
            homes = [c for c in map(first.__getitem__, mine) if c >= 0]
            if homes:
                home = min(homes)
            else:
                home, clusters = clusters, clusters + 1
            for m in mine:
                if not 0 <= first[m] <= home:
                    first[m] = home
                if last[m] < home:
                    last[m] = home
        last = np.array(last)
        kept = np.flatnonzero(last >= 0)
        return table.select([*by, "pos"]).take(np.flatnonzero(fresh)[kept]).append_column("cluster", pa.array(last[kept]))

    centres = boxes.select(*by, "pos", *(((F.col(f"{c}1") + F.col(f"{c}2")) / 2).cast("double").alias(f"c{c}") for c in "xy"))
    return fold_groups(centres, by, fold, ", ".join(f"{c} {kinds[c]}" for c in by) + ", pos long, cluster long")


def validated_shifts(rows: DataFrame, by: list[str], width: float, keep: int = 5, margin: float = 5.0, true_border: bool = False) -> DataFrame:
    """`tx` and `ty`, where a tx within `margin` of 0 or of `width` is a border case: both become the means of the last `keep` valid ones, once there are so many.

    Rows without tx pass and count for nothing. With `true_border`, values pass after more than 2 * `keep` border cases in a row.
    """

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        last: list[tuple[float, float]] = []
        cases, out = 0, []
        for tx, ty in zip(pdf["tx"], pdf["ty"]):
            if tx is None or np.isnan(tx):
                out.append((None, ty))
                continue
            if margin <= tx <= width - margin:
                last, cases = [*last, (float(tx), float(ty))][-keep:], 0
            elif not (true_border and cases > 2 * keep):
                cases += 1
                tx, ty = np.mean(last, axis=0) if len(last) == keep else (tx, ty)
            out.append((float(tx), float(ty)))
        return pd.DataFrame({"frame": pdf["frame"].to_numpy(), "tx": [x for x, _ in out], "ty": [y for _, y in out]})

    return _per_scan(rows, by, "frame long, tx double, ty double", fold)
