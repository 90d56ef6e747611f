"""The folder that driver and executors share, and tables written there between the rounds of an operator."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: str | None = None


def shared_root(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, or else the checkpoint folder of the context; one of our own only on one machine."""
    global _own
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if _own is None:
        _own = "file://" + tempfile.mkdtemp(prefix="spark-fieldloom-core-")
    return _own


def shared_folder(spark: SparkSession, label: str) -> str:
    """A path of a folder that does not exist yet; what is written there goes when the application ends."""
    path = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def written(rows: DataFrame, label: str) -> DataFrame:
    """`rows` as a table in the shared folder: lineage is cut, and a lost executor costs a re-read."""
    path = shared_folder(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
