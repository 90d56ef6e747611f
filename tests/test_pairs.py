"""Pairs of boxes and of identities, found in folds over many frames or scans."""

import itertools
import random

import pytest

from fieldloom.operators import evaluation, scoring
from fieldloom.plans import scores, stateful

IMAGE = ["scan_id", "frame"]
BOX = "scan_id int, frame int, pos long, x1 int, y1 int, x2 int, y2 int"
PAIRS = "scan_id int, frame int, gt_id double, trk_id double, iou double"
SF = "/root/testdata/sf0.001"


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_boxes_and_pairs_are_shuffled_once(spark):
    truth = spark.createDataFrame([], BOX + ", gt_id double")
    found = spark.createDataFrame([], BOX + ", trk_id double")
    pairs = scoring.track_pairs(truth, found, IMAGE, 0.5)
    assert shuffles(pairs) == 1 and shuffles(scoring.without_ignored(found, truth, IMAGE)) == 1 and pairs.count() == 0
    assert shuffles(scoring.identity_summary(spark.createDataFrame([], PAIRS), ["scan_id"], 0.5)) == 1
    assert shuffles(scores._pairs(spark, SF)) == 3  # numbering of lines, identities of a frame, pairs of a frame


@pytest.mark.parametrize("seed", range(40))
def test_most_pairs_equal_all_choices(seed):
    rng = random.Random(seed)
    gain = {(rng.randrange(4), rng.randrange(4)): rng.random() for _ in range(rng.randrange(8))}
    fits = (c for n in range(len(gain) + 1) for c in itertools.combinations(gain, n) if len({a for a, _ in c}) == len({b for _, b in c}) == n)
    best = max(fits, key=lambda c: (len(c), sum(gain[p] for p in c)))
    assert scoring.most_pairs(gain) == dict(best)


def test_boxes_without_a_frame_meet_none(spark):
    """They are named, as all boxes are; so are boxes without coordinates or without area."""
    truth = spark.createDataFrame([(0, None, 1, 0, 0, 9, 9, 1.0), (0, 1, 2, None, 0, 9, 9, 2.0), (0, 1, 3, 5, 5, 5, 5, 3.0)], BOX + ", gt_id double")
    found = truth.withColumnRenamed("gt_id", "trk_id")
    got = scoring.track_pairs(truth, found, IMAGE, 0.5).collect()
    assert sorted((r.gt_id, r.trk_id) for r in got if r.gt_id) == [(1.0, None), (2.0, None), (3.0, None)] and len(got) == 6
    kept = scoring.without_ignored(found, truth, IMAGE)
    assert kept.schema == found.schema and sorted(r.pos for r in kept.collect()) == [1, 2, 3]


def test_pairs_are_shuffled_once_for_matches(spark):
    assert shuffles(evaluation.mot_summary(spark.createDataFrame([], PAIRS), ["scan_id"], 0.5)) == 1


def test_a_match_is_kept_across_calls_and_gaps(spark):
    """Scans of many frames in any order of rows: the pair of the frame before goes before a better overlap, frames without pairs do not end it."""
    rows = [(s, f, 1.0, float(f % 7 == 3) + 7, 0.9) for s in range(30) for f in range(60) if f % 5] + [(s, f, 1.0, 7.0, 0.5) for s in range(30) for f in range(60) if f % 7 == 3 and f % 5]
    rows += [(s, f, 1.0, None, 0.0) for s in range(30) for f in range(60)] + [(None, 1, 1.0, 7.0, 0.9)]
    random.Random(1).shuffle(rows)
    got = {r.scan_id: (r.matches, r.misses, r.false_positives, r.switches) for r in evaluation.mot_summary(spark.createDataFrame(rows, PAIRS), ["scan_id"], 0.5).collect()}
    n = sum(f % 7 == 3 and f % 5 > 0 for f in range(60))
    assert got == {s: (48, 12, n, 0) for s in range(30)} | {None: (1, 0, 0, 0)}


def test_sides_of_found_tracks_come_of_one_table(spark):
    assert shuffles(stateful._mot(spark, SF)) == 3
