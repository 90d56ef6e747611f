"""New ids of one large source are given by many tasks."""

from pyspark.sql import functions as F

from fieldloom.operators import annotations


def test_one_source_is_numbered_in_ranges(spark):
    images = spark.range(40).select(F.lit("a").alias("source"), "id")
    notes = spark.range(4000).select(F.lit("a").alias("source"), (4000 - F.col("id")).alias("id"), (F.col("id") % 40).alias("image_id"))
    notes = notes.union(spark.createDataFrame([("a", 9000, 77), (None, 1, 1)], "source string, id long, image_id long")).union(notes.where("id = 7"))
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, False)
    try:
        got = annotations.renumbered(images.union(spark.createDataFrame([(None, 3)], "source string, id long")), notes, "source")[1]
        rows = got.withColumn("part", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset(setting)
    olds = sorted([*range(1, 4001), 7])
    assert sorted((r.new_id, r.new_image) for r in rows) == [(n, (4000 - old) % 40 + 1) for n, old in enumerate(olds, 1)]
    assert max(sum(r.part == p for r in rows) for p in {r.part for r in rows}) < len(rows) * 0.8
