"""Batched prediction and gating distances against plain loops, and what gating changes."""

import numpy as np
import pandas as pd
import pytest

from fieldloom.operators import tracking


def tracks(rng, n):
    kalman, means, covs = tracking.ConstantVelocity(), [], []
    for _ in range(n):
        mean, cov = kalman.begin(np.array([*rng.uniform(0, 1000, 2), rng.uniform(0.3, 2), rng.uniform(10, 200)]))
        for _ in range(int(rng.integers(0, 5))):
            mean, cov = (x[0] for x in kalman.predict(mean[None], cov[None]))
            mean, cov = kalman.update(mean, cov, mean[:4] + rng.normal(0, 3, 4) * [1, 1, 0.01, 1])
        means.append(mean)
        covs.append(cov)
    return kalman, np.stack(means), np.stack(covs)


def test_prediction_and_distances_equal_plain_loops():
    rng = np.random.default_rng(9)
    kalman, means, covs = tracks(rng, 12)
    step = np.eye(8)
    for k in range(4):
        step[k, k + 4] = 1
    for (m, c), mean, cov in zip(zip(*kalman.predict(means, covs)), means, covs):
        h = mean[3]
        std = np.array([h / 20, h / 20, 1e-2, h / 20, h / 160, h / 160, 1e-5, h / 160])
        assert np.allclose(m, step @ mean) and np.allclose(c, step @ cov @ step.T + np.diag(std**2))
    measured = means[:7, :4] + rng.normal(0, 5, (7, 4)) * [1, 1, 0.01, 1]
    for only in (False, True):
        k = 2 if only else 4
        got = kalman.distances(means, covs, measured, only)
        for i in range(len(means)):
            h = means[i, 3]
            inner = covs[i, :4, :4] + np.diag(np.array([h / 20, h / 20, 1e-1, h / 20]) ** 2)
            for j in range(len(measured)):
                d = measured[j, :k] - means[i, :k]
                assert np.isclose(got[i, j], d @ np.linalg.inv(inner[:k, :k]) @ d)


def ids(boxes, **kw):
    pdf = pd.DataFrame([(f, 10 * f + k, *b, 0.9) for f, own in enumerate(boxes) for k, b in enumerate(own)], columns=["frame", "pos", "x1", "y1", "x2", "y2", "score"])
    return {r.pos: r.track_id for r in tracking.two_stage_scan(pdf, tracking.TwoStageTracker(**kw)).itertuples()}


@pytest.mark.parametrize("only", [False, True])
def test_gating_refuses_a_jump_that_overlaps(only):
    """Ten frames at rest, then a box that overlaps well but lies where nothing so steady can have gone."""
    still = [[(100, 100, 200, 160)]] * 10
    jump = [[(145, 100, 245, 160)]]
    assert ids(still + jump)[100] == 0
    assert 100 not in ids(still + jump, gated=True, centre_only=only)
    assert ids(still + [[(104, 100, 204, 160)]], gated=True, centre_only=only)[100] == 0


def test_motion_decides_between_equal_overlaps():
    """Two detections overlap the prediction alike; the one whose height fits costs less."""
    moving = [[(100 + 10 * f, 100, 160 + 10 * f, 160)] for f in range(10)]
    last = [[(200, 100, 260, 170), (200, 110, 260, 160)]]
    got = ids(moving + last, gated=True, looks=0.0, first_most=9.0)
    kalman = tracking.ConstantVelocity()
    mean, cov = kalman.begin(tracking._measured(np.array(moving[0][0], float)))
    for own in moving[1:]:
        mean, cov = (x[0] for x in kalman.predict(mean[None], cov[None]))
        mean, cov = kalman.update(mean, cov, tracking._measured(np.array(own[0], float)))
    mean, cov = kalman.predict(mean[None], cov[None])
    d = kalman.distances(mean, cov, np.stack([tracking._measured(np.array(b, float)) for b in last[0]]))[0]
    assert got[100 + int(np.argmin(d))] == 0 and d.min() < 9


def test_filter_is_asked_by_frame_not_by_track(monkeypatch):
    """Tracks of a frame are begun in one call and moved in one call for each of the three ways of matching; and all boxes are followed."""
    calls = dict.fromkeys(("begin", "predict", "update"), 0)

    def counted(name, of):
        def call(*a):
            calls[name] += 1
            return of(*a)

        return call

    for name in calls:
        monkeypatch.setattr(tracking.ConstantVelocity, name, counted(name, getattr(tracking.ConstantVelocity, name)))
    rng = np.random.default_rng(3)
    moving = [[(100 * (k % 10) + 4 * f + x, 100 * (k // 10), 100 * (k % 10) + 4 * f + 60, 100 * (k // 10) + 60) for k, x in enumerate(rng.uniform(0, 3, 10))] for f in range(12)]
    got = ids(moving, gated=True)
    assert got == {10 * f + k: k for f in range(12) for k in range(10)}
    assert calls["begin"] <= 12 and calls["predict"] <= 12 and calls["update"] <= 3 * 12


def test_scans_are_dealt_to_as_many_tasks_as_asked_for(spark):
    """Scans of few bytes are not put together into fewer tasks, and are shuffled once with what the tracker reads."""
    rows = spark.range(40).selectExpr("id % 10 as scan_id", "id div 10 as frame", "id as pos", "100 as x1", "100 as y1", "150 as x2", "150 as y2", "0.9D as score", "repeat('x', 50) as more")
    got = tracking.two_stage_tracks(rows, ["scan_id"])
    assert got.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_NUM" in plan and "more" not in plan
    assert got.count() == 40
