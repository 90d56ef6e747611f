"""Shuffled orders: bijections, disjoint readers, epochs of their own."""

import pytest
from pyspark.sql import functions as F

from fieldloom.operators import sampling


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 100, 101, 997])
def test_permutations_are_bijections(spark, n):
    rows = spark.range(n)
    got = [[r[0] for r in rows.orderBy("id").select(sampling.permuted(F.col("id"), n, seed)).collect()] for seed in ("a", "a", "b")]
    assert all(sorted(g) == list(range(n)) for g in got) and got[0] == got[1]
    assert n < 17 or got[0] != got[2] and sum(x == k for k, x in enumerate(got[0])) < 8


def test_readers_share_an_endless_stream(spark):
    """Three readers over four epochs of 100 rows: every place once, each epoch complete, whatever the partitions."""
    rows = spark.range(100).withColumn("key", 1000 - F.col("id")).repartition(7)
    epochs = [sampling.strided(rows, ["key"], 3, e, "x").collect() for e in range(4)]
    assert sorted(r.place for e in epochs for r in e) == list(range(400))
    assert all(sorted(r.id for r in e) == list(range(100)) for e in epochs)
    assert all(r.reader == r.place % 3 and r.step == r.place // 3 for e in epochs for r in e)
    orders = [[r.id for r in sorted(e, key=lambda r: r.place)] for e in epochs]
    assert len({tuple(o) for o in orders}) == 4
    again = sampling.strided(rows.repartition(2), ["key"], 3, 2, "x").collect()
    assert [r.id for r in sorted(again, key=lambda r: r.place)] == orders[2]
    mine = [r.id for r in sampling.shard_of(rows, ["key"], 1, 3, 2, "x").orderBy("step").collect()]
    assert mine == [i for k, i in enumerate(orders[2], 200) if k % 3 == 1]
    assert sampling.strided(rows.limit(0), ["key"], 3).count() == 0
