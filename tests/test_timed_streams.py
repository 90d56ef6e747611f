"""Streams with timers: rules by hand in any cut into batches, state that shrinks over a replay, late rows."""

import itertools

import pandas as pd
import pytest

from fieldloom.streaming import jobs, timed

SF = "/root/testdata/sf0.001"


class Handle:
    """The state and the timers of one key."""

    def __init__(self):
        self.held, self.timers = None, set()

    def getValueState(self, name, schema):  # noqa: N802
        return self

    def exists(self):
        return self.held is not None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value

    def clear(self):
        self.held = None

    def registerTimer(self, at):  # noqa: N802
        self.timers.add(at)

    def deleteTimer(self, at):  # noqa: N802
        self.timers.remove(at)


def run(processor, events, cuts):
    """What is said of the events (kind, id, time) cut into batches; after each, timers that the latest time has passed go off, at the end all."""
    handle, out = Handle(), []
    processor.init(handle)
    edges = [0, *cuts, len(events)]
    for low, high in zip(edges, edges[1:]):
        rows = pd.DataFrame([(k, i, t) for k, i, t in events[low:high]], columns=["event_type", "event_id", "us"])
        if len(rows):
            # In two parts and out of order, as a batch may come.
            for part in processor.handleInputRows((7,), iter([rows[1::2], rows[::2]]), None):
                out += part.itertuples(index=False, name=None)
        for at in sorted(t for t in handle.timers if high == len(events) or t * 1000 < events[high - 1][2]):
            handle.timers.remove(at)
            for part in processor.handleExpiredTimer((7,), None, None):
                out += part.itertuples(index=False, name=None)
    assert handle.held is None and not handle.timers
    return sorted(out)


S = 1_000_000
CASES = [
    (
        timed.MarkedSessions(["start"], ["stop", "crash"], 10 * S),
        [("other", 1, 0), ("start", 2, 1 * S), ("other", 3, 2 * S), ("other", 4, 12 * S), ("stop", 5, 13 * S), ("other", 6, 14 * S), ("start", 7, 15 * S), ("start", 8, 16 * S), ("other", 9, 27 * S), ("crash", 10, 28 * S), ("start", 11, 40 * S)],
        # Ten seconds are still in time, eleven are not; what comes after a session is in none.
        [(7, 1 * S, 13 * S, 2, "stopped"), (7, 15 * S, 16 * S, 0, "restarted"), (7, 16 * S, 26 * S, 0, "silent"), (7, 40 * S, 50 * S, 0, "silent")],
    ),
    (timed.Silences(5 * S), [("a", 1, 0), ("a", 2, 5 * S), ("a", 3, 10 * S + 1), ("a", 4, 11 * S)], [(7, 2, 10 * S), (7, 4, 16 * S)]),
    (
        timed.NearestWithin("l", "r", 4 * S),
        [("l", 1, 0), ("r", 2, 3 * S), ("l", 3, 5 * S), ("r", 4, 7 * S), ("l", 5, 8 * S), ("l", 6, 11 * S), ("l", 7, 12 * S), ("r", 8, 15 * S + 1), ("l", 9, 40 * S), ("r", 10, 44 * S), ("l", 11, 60 * S)],
        # 3 is as near to 2 as to 4 and takes the later; 6 waits to the end of its time and turns back to 4; 7 has only 8 within reach; 11 is dropped.
        [(7, 1, 2, 3 * S), (7, 3, 4, 2 * S), (7, 5, 4, 1 * S), (7, 6, 4, 4 * S), (7, 7, 8, 3 * S + 1), (7, 9, 10, 4 * S)],
    ),
    (timed.TimedFlush(2, 5 * S), [("a", 1, 0), ("a", 2, 1 * S), ("a", 3, 2 * S), ("a", 4, 8 * S), ("a", 5, 9 * S), ("a", 6, 10 * S)], [(7, 0, 2), (7, 2 * S, 1), (7, 8 * S, 2), (7, 10 * S, 1)]),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_rules_by_hand_in_all_cuts(case):
    processor, events, want = CASES[case]
    for n in range(4):
        for cuts in itertools.combinations(range(1, len(events)), n):
            assert run(processor, events, cuts) == sorted(want), cuts


def test_state_shrinks_over_a_replay(spark):
    """Users who are silent leave the state: it is never that of all users so far, and nothing is left at the end."""
    progress = []
    out = jobs.replayed(spark, SF, lambda e: timed.silences(e, timed.DAY // 4), "append", progress=progress)
    assert out.count() > 300
    held = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]]
    assert len(held) >= 4 and max(held) > 0 and held[-1] == 0 and min(held[1:-1]) < max(held)


def test_rows_later_than_the_watermark_are_dropped(spark):
    """A tenth of the first days' rows come five days before the end: they open no session and change none."""
    late = "event_id % 10 = 0 and ts < timestamp_ntz'2024-01-05 00:00:00'"
    got = jobs.replayed(spark, SF, lambda e: timed.silences(e, timed.DAY), "append", late=late)
    events = spark.read.parquet(f"{SF}/events.parquet")
    on_time = events.where(f"not ({late})")
    want = {r.user_id for r in on_time.select("user_id").distinct().collect()}
    assert {r.user_id for r in got.select("user_id").distinct().collect()} == want
    dropped = {r.event_id for r in events.where(late).collect()}
    assert dropped and not dropped & {r.event_id for r in got.collect()}


def test_batches_are_written_by_many_tasks_and_read_in_order(spark):
    path, numbers = jobs.staged_days(spark, SF)
    assert numbers == [0, 2, 4, 1 << 30]
    rows = spark.read.parquet(path)
    assert rows.count() == spark.read.parquet(f"{SF}/events.parquet").count() + 1
    spans = rows.groupBy("batch").agg({"ts": "min"}).orderBy("batch").collect()
    assert [s[1] for s in spans] == sorted(s[1] for s in spans)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_a_key_that_says_nothing_costs_little(monkeypatch):
    """No table of pandas is made for a key's rows, none is given back empty, and the state is asked once a batch."""
    calls, handle = [], Handle()
    monkeypatch.setattr(Handle, "exists", lambda self: calls.append("exists") or self.held is not None)
    monkeypatch.setattr(Handle, "clear", lambda self: calls.append("clear"))
    monkeypatch.setattr(pd, "concat", None)
    processor = timed.MarkedSessions(["start"], ["stop"], 10 * S)
    processor.init(handle)
    rows = pd.DataFrame([("other", 2, 2 * S), ("other", 1, S)], columns=["event_type", "event_id", "us"])
    assert list(processor.handleInputRows((7,), iter([rows]), None)) == [] and not calls and not handle.timers
    assert list(processor.handleExpiredTimer((7,), None, None)) == [] and not calls
    assert jobs.in_order(iter([rows]), "event_type") == [(S, 1, "other"), (2 * S, 2, "other")]
