"""From documents to tokens: toxicity, quality, near duplicates, mixing, encoding. Each stage works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.llm import near_duplicates, quality_rules, registry, sentencepiece, toxicity
from fieldloom.llm.common import materialised_alone

#: Columns that all stages but the last return.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under the threshold; the model learns from `labels` outside the held-out fold.

    Null and empty texts have the score of no words, and stay; repeated rows are each judged. Without a toxic label all stay. An empty table
    gives an empty result.
    """
    params = toxicity.Params()
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), params)
    return toxicity.with_scores(docs.select(*COLUMNS), model).where(F.col("__toxicity") < params.threshold).select(*COLUMNS)


def of_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the word rules and the compression bands keep. Null, empty and short texts go; repeated rows are each judged. An empty
    table gives an empty result.
    """
    return quality_rules.with_quality(docs.select(*COLUMNS)).where("__q_kept").select(*COLUMNS)


def _keyed(docs: DataFrame) -> DataFrame:
    """`docs` with `__key`: the doc_id, or where there is none a number beyond all usual ids that depends on the whole row."""
    beyond = F.lit(1 << 62).bitwiseOR(F.xxhash64("text", "lang", "source", "n_chars").bitwiseAND(F.lit((1 << 62) - 1)))
    return docs.select(*COLUMNS).withColumn("__key", F.coalesce("doc_id", beyond))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group; one without doc_id stays only where its group has no doc_id at all.

    Rows with one doc_id and one text are one, with the least (lang, source, n_chars); different texts under one doc_id all stay,
    if it is kept. Null, empty and blank texts have no group. An empty table gives an empty result.
    """
    keyed = _keyed(docs)
    kept = near_duplicates.near_duplicates(keyed.select(F.col("__key").alias("doc_id"), "text")).where("kept").select(F.col("doc_id").alias("__kept")).distinct()
    left = keyed.join(kept, F.col("__key") == F.col("__kept"), "left_semi")
    rest = F.min(F.struct("lang", "source", "n_chars")).alias("rest")
    return left.groupBy("__key", "doc_id", F.md5("text").alias("__text")).agg(F.first("text").alias("text"), rest).select("doc_id", "text", "rest.*")


def to_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample that meets the raked shares of sources, languages and topics. Null classes count as those not named; repeated rows are drawn
    alike; an empty table gives an empty result.
    """
    return registry.mixed(docs.select(*COLUMNS)).where("__draw < __cut").select(*COLUMNS)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, tokens, exact of every row; a null text has null tokens. An empty table gives an empty result."""
    return sentencepiece.encode(docs, registry.vocabulary(spark))


STAGES = [
    ("toxicity", without_toxic),
    ("quality", of_quality),
    ("near_duplicates", without_near_duplicates),
    ("mixing", to_target_weights),
    ("sentencepiece", to_tokens),
]

#: No SQL for training, zstandard, MinHash or Viterbi; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again; a stage's own tables and its input's go when it is done."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialised_alone(spark, lambda: stage(spark, docs, sf_dir), name, last=docs)
    return STAGES[-1][1](spark, docs, sf_dir)
