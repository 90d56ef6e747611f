"""Stateful streams with timers: what a key leaves in the state goes when event time has passed it, so that the state follows the keys that are active."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .jobs import CLOSE, in_order

#: Microseconds.
DAY = 86_400_000_000


class _Timed(StatefulProcessor):
    """One value and one timer for each user. Rows of a batch come to `row` in order of (time, event_id); what has been silent too long goes to `over`.

    A timer is set for the time after which the state means nothing more; a row that comes later than that finds the state already settled, whether the
    timer has run or not, so that results do not depend on how rows fall into batches.
    """

    state: str
    columns: list[str]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.value = handle.getValueState("value", f"due long, {self.state}")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        got = self.value.get()  # each call of the state is a message to the engine and back
        due, now, out = (got[0], tuple(got[1:]), []) if got else (None, None, [])
        timer = due
        for at, ident, kind in in_order(rows, "event_type"):
            if kind == CLOSE:
                continue
            if now is not None and at > due:
                out += self.over(key[0], now, due)
                now = None
            now, due = self.row(key[0], now, kind, ident, at, out)
        if now is None:
            due = None
            if got:
                self.value.clear()
        else:
            self.value.update((due, *now))
        if due != timer:
            if timer is not None:
                self.handle.deleteTimer(timer // 1000 + 1)
            if due is not None:
                self.handle.registerTimer(due // 1000 + 1)
        if out:
            yield pd.DataFrame(out, columns=self.columns)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        got = self.value.get()
        out = self.over(key[0], tuple(got[1:]), got[0]) if got else []
        if got:
            self.value.clear()
        if out:
            yield pd.DataFrame(out, columns=self.columns)

    def close(self) -> None:
        pass

    def row(self, user: int, now: tuple | None, kind: str, ident: int, at: int, out: list) -> tuple[tuple | None, int | None]:
        """The state after a row, and when it is over."""
        raise NotImplementedError

    def over(self, user: int, now: tuple, due: int) -> list[tuple]:
        """What is said when nothing came until `due`."""
        raise NotImplementedError


class MarkedSessions(_Timed):
    state, columns = "started long, n long", ["user_id", "started", "ended", "n", "how"]

    def __init__(self, starts: list[str], stops: list[str], silence: int):
        self.starts, self.stops, self.silence = frozenset(starts), frozenset(stops), silence

    def row(self, user, now, kind, ident, at, out):
        if kind in self.starts:
            if now is not None:
                out.append((user, now[0], at, now[1], "restarted"))
            return (at, 0), at + self.silence
        if now is None:
            return None, None
        if kind in self.stops:
            out.append((user, now[0], at, now[1], "stopped"))
            return None, None
        return (now[0], now[1] + 1), at + self.silence

    def over(self, user, now, due):
        return [(user, now[0], due, now[1], "silent")]


class Silences(_Timed):
    state, columns = "last long", ["user_id", "event_id", "released"]

    def __init__(self, silence: int):
        self.silence = silence

    def row(self, user, now, kind, ident, at, out):
        return (ident,), at + self.silence

    def over(self, user, now, due):
        return [(user, now[0], due)]


class NearestWithin(_Timed):
    """The state is the last right event and the left ones since, each with its time."""

    state, columns = "right array<long>, ids array<long>, times array<long>", ["user_id", "event_id", "other", "gap_us"]

    def __init__(self, left: str, right: str, wait: int):
        self.left, self.right, self.wait = left, right, wait

    def _settled(self, user, right, ids, times, until, out) -> tuple[list, list]:
        """Left events that have waited too long take the right one before them, if it is near enough; the others stay."""
        for i, t in zip(ids, times):
            if t < until and right and t - right[1] <= self.wait:
                out.append((user, i, right[0], t - right[1]))
        kept = [(i, t) for i, t in zip(ids, times) if t >= until]
        return [i for i, _ in kept], [t for _, t in kept]

    def row(self, user, now, kind, ident, at, out):
        right, ids, times = (list(x) for x in now) if now else ([], [], [])
        ids, times = self._settled(user, right, ids, times, at - self.wait, out)
        if kind == self.left:
            ids.append(ident)
            times.append(at)
        elif kind == self.right:
            for i, t in zip(ids, times):
                back = bool(right) and t - right[1] <= self.wait and t - right[1] < at - t
                out.append((user, i, right[0] if back else ident, t - right[1] if back else at - t))
            right, ids, times = [ident, at], [], []
        due = max([*times[-1:], *right[1:]], default=None)
        return ((right, ids, times), due + self.wait) if due is not None else (None, None)

    def over(self, user, now, due):
        out: list = []
        right, ids, times = (list(x) for x in now)
        self._settled(user, right, ids, times, due + 1, out)
        return out


class TimedFlush(_Timed):
    state, columns = "started long, n long", ["user_id", "started", "n"]

    def __init__(self, size: int, silence: int):
        self.size, self.silence = size, silence

    def row(self, user, now, kind, ident, at, out):
        started, n = now or (at, 0)
        started, n = (at, 0) if n == self.size else (started, n)
        if n + 1 == self.size:
            out.append((user, started, self.size))
        return (started, n + 1), at + self.silence

    def over(self, user, now, due):
        return [] if now[1] == self.size else [(user, now[0], now[1])]


def _timed(events: DataFrame, processor: _Timed, schema: str, late: str) -> DataFrame:
    """Rows later than the watermark are dropped by the engine before they reach the state."""
    timed = events.withColumn("us", F.unix_micros(F.col("ts").cast("timestamp"))).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    kept = timed.select("user_id", "event_id", "event_type", "us", "ts")
    return kept.groupBy("user_id").transformWithStateInPandas(statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="EventTime")


def marked_sessions(events: DataFrame, starts: list[str], stops: list[str], silence: int, late: str = "0 seconds") -> DataFrame:
    """(user_id, started, ended, n, how), times in microseconds: what lies between a start and a stop of a user, with the number of events between.

    `how` is stopped, restarted (by another start), or silent: no event for more than `silence` microseconds, and the session ended when they were over.
    Events outside a session count for nothing.
    """
    return _timed(events, MarkedSessions(starts, stops, silence), "user_id long, started long, ended long, n long, how string", late)


def silences(events: DataFrame, silence: int, late: str = "0 seconds") -> DataFrame:
    """(user_id, event_id, released): each event after which a user was silent for more than `silence` microseconds, and when those were over."""
    return _timed(events, Silences(silence), "user_id long, event_id long, released long", late)


def nearest_within(events: DataFrame, left: str, right: str, wait: int, late: str = "0 seconds") -> DataFrame:
    """(user_id, event_id, other, gap_us): each left event with the right one nearest in time, within `wait` microseconds on either side, the later of equals.

    A left event waits for a right one no longer than that; then it takes the one before, or is dropped. A user's state holds `wait` of events at most.
    """
    return _timed(events.where(F.col("event_type").isin(left, right, CLOSE)), NearestWithin(left, right, wait), "user_id long, event_id long, other long, gap_us long", late)


def timed_flush(events: DataFrame, size: int, silence: int, late: str = "0 seconds") -> DataFrame:
    """(user_id, started, n): a row for each `size` events of a user, and one for what is left when the user has been silent for more than `silence` microseconds."""
    return _timed(events, TimedFlush(size, silence), "user_id long, started long, n long", late)
