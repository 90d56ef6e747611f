"""Ranked lexical search by Fagin's threshold algorithm: impact-sorted lists read in turn, whole scores from a forward index, an exact stop."""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WordHasher, grouped_words, materialise, text_groups

#: Bytes that stand between terms: ASCII but for digits and letters.
_BREAKS = np.ones(256, bool)
_BREAKS[0x30:0x3A] = _BREAKS[0x41:0x5B] = _BREAKS[0x61:0x7B] = _BREAKS[0x80:] = False


@dataclass(frozen=True)
class Params:
    """`k` documents of each item; a block of items holds at most `block_terms` distinct terms (one item may hold more), and a shard of the index at most
    `cells` places of its forward index and about `shard_bytes` of text.
    """

    k: int = 10
    block_terms: int = 8192
    cells: int = 1 << 24
    shard_bytes: int = 4 << 20


def _terms(texts: list[bytes]):
    return grouped_words(WordHasher(breaks=_BREAKS), texts)


def _blocks(items: DataFrame, p: Params):
    """Blocks of (item_id, Counter of term hashes), in the order of item_id."""
    block, seen = [], set()
    for row in items.toLocalIterator():
        own = Counter(map(int, next(_terms([(row["text"] or "").encode()]))))
        if block and len(seen | own.keys()) > p.block_terms:
            yield block, np.array(sorted(seen), np.uint64)
            block, seen = [], set()
        block.append((row["item_id"], own))
        seen |= own.keys()
    if block:
        yield block, np.array(sorted(seen), np.uint64)


def _found(vocabulary: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions in `hashes`, places in `vocabulary`) of the hashes that the vocabulary holds."""
    if not len(vocabulary):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    held = np.flatnonzero(vocabulary[at] == hashes)
    return held, at[held]


def _shards(batches, vocabulary: np.ndarray, p: Params):
    """(ids, terms of each document, document, term, occurrences) of pieces of the table; only terms of the vocabulary, by document and term."""
    hasher, width = WordHasher(breaks=_BREAKS), max(1, len(vocabulary))
    most = max(1, p.cells // width)
    for batch in batches:
        ids = batch.column(0)
        for first, parts in text_groups(batch.column(1).cast(pa.binary()), p.shard_bytes):
            for low in range(0, len(parts), most):
                own = list(grouped_words(hasher, parts[low : low + most]))
                n = np.fromiter(map(len, own), np.int64, len(own))
                held, term = _found(vocabulary, np.concatenate(own))
                doc = np.searchsorted(np.cumsum(n), held, side="right")
                keys, tf = np.unique(doc * width + term, return_counts=True)
                yield ids.slice(first + low, len(own)), n, keys // width, keys % width, tf


def _counts(vocabulary: np.ndarray, p: Params):
    """Of a task's documents: for each term how many hold it, and (term -1) how many hold any term and how many terms there are."""

    def run(batches):
        df, held, total = np.zeros(len(vocabulary), np.int64), 0, 0
        for _, n, _, term, _ in _shards(batches, vocabulary, p):
            df += np.bincount(term, minlength=len(vocabulary))
            held += int((n > 0).sum())
            total += int(n.sum())
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(df[at], held)), pa.array(np.append(np.zeros_like(at), total))], names=["term", "docs", "terms"])

    return run


class _Index:
    """A shard: impact-sorted lists of its terms, and a forward index of impacts by document and term."""

    def __init__(self, ids: pa.Array, n: np.ndarray, doc, term, tf, width: int, stats: tuple[int, int]):
        documents, total = stats
        m = 100 - 75 + (75 * n * documents) // max(1, total)
        impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])
        self.forward = np.zeros((len(n), width), np.int32)  # below a million, as 1000 occurrences divide it
        self.forward[doc, term] = impact
        order = np.lexsort((-impact, term))
        self.docs, self.impacts = doc[order], impact[order]
        self.starts = np.searchsorted(term[order], np.arange(width + 1))
        self.seen = np.zeros(len(n), bool)
        null = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = np.where(null, np.iinfo(np.int64).max, ids.fill_null(0).to_numpy(zero_copy_only=False))


def threshold_search(index: _Index, terms: np.ndarray, factors: np.ndarray, k: int, best: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The k best (scores, ids) of those in `best` and the shard's documents, highest score first, ties by id; score = sum of factor * impact over the terms.

    The lists of the terms are read in turn, a block of places at a time; every new document is looked up in the forward index. It ends when the
    threshold, which is the score of a document with the last impact read of each list, is strictly below the k-th score, or all lists are read.
    """
    used = (factors > 0) & (index.starts[terms] < index.starts[terms + 1])
    terms, factors = terms[used], factors[used]
    if not len(terms):
        return best
    first, size = index.starts[terms], index.starts[terms + 1] - index.starts[terms]
    index.seen[:] = False
    depth, step, longest = 0, 8, int(size.max())
    while depth < longest:
        places = np.arange(depth, min(depth + step, longest))
        met = index.docs[(first[:, None] + places)[places < size[:, None]]]
        met = np.unique(met[~index.seen[met]])
        index.seen[met] = True
        scores = (index.forward[np.ix_(met, terms)] * factors).sum(axis=1)
        if len(best[0]) >= k:
            good = scores >= best[0][-1]
            met, scores = met[good], scores[good]
        if len(met):
            scores, ids = np.concatenate([best[0], scores]), np.concatenate([best[1], index.ids[met]])
            top = np.lexsort((ids, -scores))[:k]
            best = scores[top], ids[top]
        depth, step = int(places[-1]) + 1, min(2 * step, 512)
        last = np.where(depth <= size, index.impacts[first + np.minimum(depth, size) - 1], 0)
        if len(best[0]) >= k and int((last * factors).sum()) < best[0][-1]:
            break
    return best


def _searched(block: list[tuple], vocabulary: np.ndarray, weights: np.ndarray, stats: tuple[int, int], p: Params):
    asked = []
    for number, (_, own) in enumerate(block):
        terms = np.searchsorted(vocabulary, np.array(sorted(own), np.uint64))
        asked.append((number, terms, weights[terms] * np.array([own[t] for t in sorted(own)], np.int64)))

    def run(batches):
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        best = {number: none for number, _, _ in asked}
        for ids, n, doc, term, tf in _shards(batches, vocabulary, p):
            index = _Index(ids, n, doc, term, tf, max(1, len(vocabulary)), stats)
            for number, terms, factors in asked:
                best[number] = threshold_search(index, terms, factors, p.k, best[number])
        number = np.concatenate([np.full(len(s), x, np.int32) for x, (s, _) in best.items()] or [np.zeros(0, np.int32)])
        scores, ids = (np.concatenate([b[c] for b in best.values()] or [none[0]]) for c in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(ids, mask=ids == np.iinfo(np.int64).max), pa.array(scores)], names=["number", "doc_id", "score"])

    return run


def ranked(docs: DataFrame, items: DataFrame, params: Params = Params()) -> DataFrame:
    """(item_id, rank, doc_id, score): of each item (item_id, text) its `k` best rows of `docs` (doc_id, text), highest score first, equal scores by ascending doc_id.

    Terms are runs of digits, letters and non-ASCII characters of whole texts, with A-Z lower-cased, found by 64-bit hashes. With N rows that have a term, L terms
    in all, and df rows that hold a term, its weight is floor(1000 * ln((2N + 2) / (2df + 1))); a row of n terms in which it occurs tf times gives
    (1000000000 * tf) div (1000 * tf + 8 * m), m = 25 + (75 * n * N) div L. A score sums weight times that over the item's terms, repeats included; only
    scores above 0 are ranked. Null and empty texts have no term. Every row counts and is ranked, repeated ones too; a null doc_id comes last among
    equal scores. Other columns are ignored; an empty table on either side gives an empty result.

    Items are read in blocks of a bounded number of terms, and each block takes two passes over `docs`: for the counts, and for the search. Every
    task indexes its own documents in shards of bounded size and searches them one after another, with the best so far of each item as the mark to beat; so no
    posting is shuffled, and a task hands on k rows of an item. These meet by item in two steps, the first one of salted groups.
    """
    p, spark = params, docs.sparkSession
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    asked = items.select("item_id", F.col("text").cast("string").alias("text")).orderBy("item_id")
    kind = items.schema["item_id"].dataType.simpleString()
    parts = []
    for block, vocabulary in _blocks(asked, p):
        counts = own.mapInArrow(_counts(vocabulary, p), "term int, docs long, terms long").groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms"))
        held = {r["term"]: (r["docs"], r["terms"]) for r in counts.collect()}  # a row for each term of the block at most
        documents, total = held.pop(-1, (0, 0))
        weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * held.get(t, (0, 0))[0] + 1))) for t in range(len(vocabulary))], np.int64)
        found = own.mapInArrow(_searched(block, vocabulary, weights, (documents, total), p), "number int, doc_id long, score long")
        names = spark.createDataFrame([(k, x) for k, (x, _) in enumerate(block)], f"number int, item_id {kind}")
        parts.append(found.where("score > 0").join(F.broadcast(names), "number"))  # as many names as the block has items
    if not parts:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    found = parts[0]
    for more in parts[1:]:
        found = found.union(more)
    best_first = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    salted = found.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(64)))
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "number", "salt").orderBy(*best_first))).where(F.col("rank") <= p.k)
    few = few.drop("salt", "rank")
    out = few.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "number").orderBy(*best_first))).where(F.col("rank") <= p.k)
    return materialise(out.select("item_id", "rank", "doc_id", "score"), "ranked")


RANKED_SQL = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
stats AS (SELECT count(*) AS n_docs, coalesce(sum(len(w)), 0)::BIGINT AS n_terms FROM docs WHERE len(w) > 0),
asked AS (
  SELECT item_id, term, count(*) AS qtf
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
held AS (
  SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM docs) SEMI JOIN asked USING (term) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS weight FROM held, stats GROUP BY term),
scored AS (
  SELECT item_id, doc_id, CAST(sum(qtf * weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM held JOIN asked USING (term) JOIN weights USING (term), stats GROUP BY item_id, doc_id),
ranks AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranks WHERE rank <= 10
"""
