"""XML documents are written compressed, in files of a bounded number of documents, and read back whole."""

import gzip

from pyspark.sql import functions as F

from fieldloom.plans import files
from fieldloom.sources import readers, writers


def test_documents_are_written_small_and_bounded(spark, tmp_path):
    path = str(tmp_path / "voc")
    rows = spark.range(700).select((F.col("id") % 2).alias("scan_id"), (F.col("id") % 100).alias("frame"), F.lit("a <b> & c").alias("name"), F.lit("u").alias("pose"), F.lit(1).alias("truncated"), F.lit(0).alias("difficult"), *(F.col("id").alias(c) for c in ("x1", "y1", "x2", "y2")))
    writers.voc_documents(rows.coalesce(1), ["scan_id", "frame"], path, most=9)
    counts = [gzip.open(f, "rt").read().count("</annotation>") for f in (tmp_path / "voc").glob("part-*.gz")]
    assert sum(counts) == 100 and max(counts) <= 9
    got = sorted((r.image, r.name, r.truncated, r.difficult, r.x1, r.y2) for r in readers.voc_objects(spark, path).collect())
    assert got == sorted((f"{k % 2}_{k % 100}", "a <b> & c", 1, 0, k, k) for k in range(700))


def test_files_of_the_query_are_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "_folder", lambda s: str(tmp_path / "voc"))
    n = files.QUERIES["voc_files"][0](spark, "/root/testdata/sf0.001").count()
    assert sum(f.stat().st_size for f in (tmp_path / "voc").glob("part-*")) < 40 * n
