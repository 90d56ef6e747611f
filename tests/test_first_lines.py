"""First rows of equal numbers."""

from fieldloom.plans import counts


def test_first_line_of_equal_numbers_is_the_first_of_the_table(spark, tmp_path):
    lines = [(9, 1, 50), (9, 1, 7), (9, 1, 60), (8, 2, 4), (8, 2, 3)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long").coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    got = counts.QUERIES["union_keep_first"][0](spark, str(tmp_path))
    assert got.columns == ["l_orderkey", "l_linenumber", "l_partkey"] and sorted(map(tuple, got.collect())) == [(8, 2, 4), (9, 1, 50)]
