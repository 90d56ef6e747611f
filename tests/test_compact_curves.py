"""Precision curves of many cells over rows that are not repeated for each cell."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from fieldloom.operators import scans, scoring, voc

BOX = "scan_id long, frame long, class long, pos long, x1 long, y1 long, x2 long, y2 long, score double, crowd int"


def _boxes(rng, n, frames, first):
    out = []
    for k in range(n):
        x, y, w, h = (int(v) for v in (*rng.integers(0, 120, 2), *rng.integers(5, 70, 2)))
        out.append((0, int(rng.integers(0, frames)), int(rng.integers(0, 3)), first + k, x, y, x + w, y + h, float(rng.integers(0, 8)) / 8, int(rng.random() < 0.2)))
    return out


def test_curves_equal_a_plain_walk_over_parts_and_batches(spark):
    rng = np.random.default_rng(5)
    rows = [(int(k % 2), float(rng.integers(0, 9)), k, int(c), int(c & rng.integers(0, 8)), int(rng.integers(1, 4))) for k, c in enumerate(rng.integers(0, 8, 700))]
    df = spark.createDataFrame(rows, "class int, score double, pos long, counts long, hits long, rank int").repartition(5)
    n_true = spark.createDataFrame([(0, [200, 0, 400]), (1, [220, 160, 370])], "class int, n_true array<long>")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 33)
    try:
        for points in (None, 11):
            got = {(r["class"], r.cell): (r.ap, r.hits_2) for r in scans.curve_figures(df, ["class"], [F.col("score").desc(), F.col("pos")], n_true, 3, points, (2,)).collect()}
            want = {}
            for kind, cell in itertools.product((0, 1), range(3)):
                true = {0: [200, 0, 400], 1: [220, 160, 370]}[kind][cell]
                own = [(r[4] >> cell & 1, r[5]) for r in sorted(rows, key=lambda r: (-r[1], r[2])) if r[0] == kind and r[3] >> cell & 1]
                tp = np.cumsum([h for h, _ in own])
                best = np.maximum.accumulate((tp / np.arange(1, len(tp) + 1))[::-1])[::-1]
                if not true:
                    continue
                if points is None:
                    ap = sum(h * b for (h, _), b in zip(own, best)) / true
                else:
                    ap = sum(next((b for t, b in zip(tp, best) if t * 10 >= k * true), 0.0) for k in range(11)) / 11
                want[kind, cell] = (ap, sum(h for h, r in own if r <= 2))
            assert got.keys() == want.keys()
            assert all(np.allclose(got[k], want[k]) for k in want)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_a_found_box_is_one_row_for_all_cells(spark):
    rng = np.random.default_rng(6)
    truth, found = (spark.createDataFrame(_boxes(rng, n, 9, first), BOX) for n, first in ((150, 0), (260, 1000)))
    found = found.drop("crowd")
    image = ["scan_id", "frame"]
    states = scoring.matched_states(truth, found, image)
    assert states.count() == 260
    figures = lambda df: {(r["class"], r.area_class, r.threshold): (r.ap, r.recall_1, r.recall_10, r.recall_100) for r in df.collect()}
    whole = figures(scoring.area_cells(scoring.matched_boxes(truth, found, image), truth, image))
    compact = figures(scoring.evaluated_cells(truth, found, image))
    assert whole.keys() == compact.keys() and all(np.allclose(whole[k], compact[k]) for k in whole)
    assert voc.claims(truth.withColumn("difficult", F.col("crowd")), found, image).count() == 260
    assert scoring.evaluated_cells(truth.limit(0), found, image).count() == 0
    assert {r.ap for r in scoring.evaluated_cells(truth, found.limit(0), image).collect()} == {0.0}
