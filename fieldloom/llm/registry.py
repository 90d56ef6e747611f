"""The queries of this subpackage, op1 to op13 and the pipeline, and their SQL twins."""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise
from . import chat, filter_audit, graph_search, licences, mixing, near_duplicates, quality_rules, ranked_search, repeats, sentencepiece, sharding, toxicity, url_filter

#: The vocabulary file is a parameter of the operator; this is the box's copy of a public one.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def vocabulary(spark: SparkSession) -> sentencepiece.Vocabulary:
    """That of the file in the setting `spark.fieldloom.vocabulary`, or else of VOCABULARY."""
    return sentencepiece.load_vocabulary(spark.conf.get("spark.fieldloom.vocabulary", VOCABULARY))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_scan(table(spark, sf_dir, "documents")).withColumn("dice", F.round("dice", 9))


#: The topics that the texts are told apart by: small words of the four languages, of being, of place and of relation.
TOPICS = {
    "being": ["is", "was", "are", "be", "ist", "war", "sind", "sein", "est", "son", "sont", "fue", "es"],
    "place": ["in", "on", "at", "from", "im", "auf", "aus", "an", "dans", "sur", "en", "sobre"],
    "relation": ["to", "for", "with", "by", "zu", "mit", "für", "von", "pour", "par", "avec", "con", "por", "para"],
}
#: Wanted shares: every source by name, one of them far from its natural share; English is held back; topics are levelled.
MIX = mixing.Targets(
    {
        "source": {f"src{k}": 0.24 if k == 0 else 0.039 for k in range(20)},
        "lang": {"en": 0.55, "de": 0.17, "fr": 0.17, "es": 0.11},
        "topic": {"being": 0.18, "place": 0.36, "relation": 0.4},
    }
)


def mixed(docs: DataFrame, targets: mixing.Targets = MIX, texts: bool = True) -> DataFrame:
    """Texts are read for words and topics once; without `texts` they are left behind there."""
    ready = mixing.with_topics(docs, TOPICS)
    ready = materialise(ready if texts else ready.drop("text"), "topics")
    return mixing.mix(ready, targets, {"source": F.col("source"), "lang": F.col("lang"), "topic": F.col("__topic")}, F.col("__words"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixed(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"), texts=False)
    return out.select(
        "doc_id",
        F.col("__tokens").alias("n_tokens"),
        F.col("__cell.source").alias("source_class"),
        F.col("__cell.lang").alias("lang_class"),
        F.col("__cell.topic").alias("topic"),
        F.round("__probability", 6).alias("probability"),
        (F.col("__draw") < F.col("__cut")).alias("kept"),
    )


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.maximal_conversations(table(spark, sf_dir, "conversations"))


def op5_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.byte_shards(table(spark, sf_dir, "documents"), 16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "begins")


def op6_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_search.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.encode(table(spark, sf_dir, "documents"), vocabulary(spark))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: The fixed rules of the query.
HOST_RULES = [
    url_filter.HostRule("allow", "com", "/"),
    url_filter.HostRule("block", "example.com", "/en/"),
    url_filter.HostRule("allow", "www.example.com", "/en/"),
    url_filter.HostRule("block", "net", "/es/"),
    url_filter.HostRule("block", "net", "/fr/"),
]


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_verdicts(table(spark, sf_dir, "pages"), HOST_RULES, url_filter.DEFAULT_GLOBS)


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.without_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = str(Path(__file__).resolve().parents[2])
    if root not in sys.path:
        sys.path.insert(0, root)
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [op1_licence_scan, op2_mix_sources, op3_near_duplicates, op4_chat_format, op5_byte_shards, op6_graph_search, op7_sentencepiece, op8_quality_rules, op9_toxicity, op10_url_filter]
    own += [op11_substring_dedup, op12_ranked_search, op13_filter_audit, pipeline]
    return {f.__name__: f for f in own}


_OP10_SQL = """
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^#]*)', 1) AS after
  FROM cut),
whole AS (SELECT page_id, host, regexp_extract(after, '^[^?]*') AS path, host || after AS seen FROM parts),
rules(verdict, rhost, rpath) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fits AS (
  SELECT page_id, rhost || rpath AS rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC) AS r
  FROM whole JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT w.page_id, w.host, w.path, f.rule,
       coalesce(f.verdict, CASE WHEN seen GLOB 'ads.*' OR seen LIKE '%/ads/%' OR seen LIKE '%/login%' OR seen LIKE '%/wp-admin/%' OR seen LIKE '%.zip' OR seen LIKE '%.exe'
         OR seen LIKE '%utm\\_%=%' ESCAPE '\\' OR seen LIKE '%sessionid=%' THEN 'block' ELSE 'allow' END) AS verdict
FROM whole w LEFT JOIN fits f ON f.page_id = w.page_id AND f.r = 1
"""


_OP3_SQL = """
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, sh FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS sh FROM worded)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM shingles a JOIN shingles b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT u, v FROM shared JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v WHERE 100 * c >= 75 * (x.n + y.n - c)),
reached(doc_id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT links.v, reached.root FROM reached JOIN links ON links.u = reached.doc_id),
components AS (SELECT doc_id, min(root) AS component_id FROM reached GROUP BY doc_id)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, component_id, w.doc_id = component_id AS kept,
       CASE WHEN len(w) = 0 THEN w.doc_id ELSE min(w.doc_id) OVER (PARTITION BY array_to_string(w, ' ')) END AS copy_of
FROM worded w LEFT JOIN sizes USING (doc_id) JOIN components USING (doc_id)
"""


#: The checksum is taken byte by byte with the usual table, which the first part builds from its polynomial.
_OP5_SQL = """
WITH codes AS (SELECT list_transform(range(256), lambda k: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k)) AS code),
sized AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size,
         xor(list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: CAST('0x' || x AS BIGINT)), lambda c, b: xor(c >> 8, code[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS text_crc32
  FROM documents, codes),
placed AS (SELECT *, CAST(sum(size) OVER w - size AS BIGINT) AS begins, row_number() OVER w AS place FROM sized WINDOW w AS (ORDER BY doc_id NULLS FIRST, size, text_crc32 ROWS UNBOUNDED PRECEDING)),
cut AS (SELECT *, CAST(begins * 16 // (SELECT sum(size) FROM sized) AS INTEGER) AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY place) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard, begins FROM cut
"""


def _mix_sql(rounds: int = 30) -> str:
    """Raking unrolled: factors of one dimension after another, as many half-steps as the operator takes at most."""
    share = {d: "CASE {d} " + " ".join(f"WHEN '{v}' THEN {w!r}" for v, w in s.items()) + " ELSE {rest!r} END" for d, s in MIX.shares.items()}
    for d, s in MIX.shares.items():
        share[d] = share[d].replace("{d}", d).replace("{rest!r}", repr(max(0.0, 1 - sum(s.values()))))
    named = {d: ", ".join(f"'{v}'" for v in s) for d, s in MIX.shares.items()}
    words = "list_transform(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'), lambda w: lower(w))"
    held = {t: f"len(list_filter({words}, lambda w: w IN ({', '.join(map(repr, own))})))" for t, own in TOPICS.items()}
    most = f"greatest({', '.join(held.values())})"
    topic = f"CASE WHEN {most} = 0 THEN NULL " + " ".join(f"WHEN {held[t]} = {most} THEN '{t}'" for t in sorted(held)) + " END"
    steps, before = [], "w0"
    k = 0
    for _ in range(rounds):
        for d in MIX.shares:
            k += 1
            steps.append(
                f"w{k} AS MATERIALIZED (SELECT source, lang, topic, tokens, weight * wanted_{d} / (SELECT sum(x) FROM (SELECT any_value(wanted_{d}) AS x FROM w0 WHERE tokens > 0 GROUP BY {d})) "
                f"/ sum(weight) OVER (PARTITION BY {d}) AS weight, wanted_source, wanted_lang, wanted_topic FROM {before})"
            )
            before = f"w{k}"
    return f"""
WITH docs AS (
  SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens,
         CASE WHEN source IN ({named['source']}) THEN source END AS source, CASE WHEN lang IN ({named['lang']}) THEN lang END AS lang,
         {topic} AS topic
  FROM documents),
cells AS (SELECT source, lang, topic, sum(n_tokens)::BIGINT AS tokens FROM docs GROUP BY ALL),
w0 AS MATERIALIZED (SELECT *, tokens::DOUBLE AS weight, {share['source']}::DOUBLE AS wanted_source, {share['lang']}::DOUBLE AS wanted_lang, {share['topic']}::DOUBLE AS wanted_topic FROM cells WHERE tokens > 0),
{", ".join(steps)},
ratios AS (SELECT source, lang, topic, tokens, weight / tokens AS ratio FROM {before}),
found AS (
  SELECT d.*, coalesce(ratio / (SELECT max(ratio) FROM ratios), 0.0) AS probability, r.tokens,
         ('0x' || substr(md5(doc_id || ':{MIX.seed}'), 1, 8))::BIGINT AS draw
  FROM docs d LEFT JOIN ratios r ON d.source IS NOT DISTINCT FROM r.source AND d.lang IS NOT DISTINCT FROM r.lang AND d.topic IS NOT DISTINCT FROM r.topic),
split AS (SELECT *, probability * tokens AS quota, 2 * n_tokens > probability * tokens AS long FROM found),
summed AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY source, lang, topic, long ORDER BY draw RANGE UNBOUNDED PRECEDING) AS so_far, sum(n_tokens) OVER (PARTITION BY source, lang, topic, long, draw) AS own,
         sum(n_tokens) OVER (PARTITION BY source, lang, topic, long) AS whole FROM split),
longs AS (SELECT *, long AND 2 * so_far - own < 2 * probability * whole AS long_kept FROM summed),
left_over AS (SELECT *, quota - sum(CASE WHEN long_kept THEN n_tokens ELSE 0 END) OVER (PARTITION BY source, lang, topic) AS rest FROM longs)
SELECT doc_id, n_tokens::BIGINT AS n_tokens, source AS source_class, lang AS lang_class, topic, round(probability, 6) AS probability,
       coalesce(CASE WHEN long THEN long_kept ELSE 2 * so_far - own < 2 * rest END, false) AS kept FROM left_over
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_licence_scan": licences.licence_sql(),
        "op2_mix_sources": _mix_sql(30),
        "op3_near_duplicates": _OP3_SQL,
        "op4_chat_format": chat.CHAT_SQL,
        "op5_byte_shards": _OP5_SQL,
        "op10_url_filter": _OP10_SQL,
        "op11_substring_dedup": repeats.REPEATS_SQL,
        "op12_ranked_search": ranked_search.RANKED_SQL,
        "op13_filter_audit": filter_audit.AUDIT_SQL,
    }
