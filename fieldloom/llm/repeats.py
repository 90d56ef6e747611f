"""Substring dedup by fixed-block anchors: blocks of the texts are indexed, every rolling window probes them, and hits grow to maximal exact repeats."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Rolling, WordHasher, grouped_words, materialise, rows_within, text_groups


@dataclass(frozen=True)
class Params:
    """A repeat has at least `window` words. Blocks have half as many, so that each window holds a whole one wherever it begins.

    A task sends what it has in pieces of about `chunk_bytes` of text; a part of the index belongs to about `part_bytes` of text.
    `most_sent` is the number of documents with repeats up to which their spans are sent to all executors.
    """

    window: int = 50
    chunk_bytes: int = 4 << 20
    part_bytes: int = 128 << 20
    most_sent: int = 200_000

    @property
    def block(self) -> int:
        return self.window // 2


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, key, text): `key` tells texts apart that share a doc_id; a null text counts as empty."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return own.select("doc_id", F.xxhash64("text").alias("key"), "text")


def _signed(batches):
    """(doc_id, key, n_words, k1, k2): the number of words, and a 128-bit hash of the word sequence."""
    hasher, rolling = WordHasher(lower=False), (Rolling(), Rolling(0x5851F42D4C957F2D))
    for batch in batches:
        for first, parts in text_groups(batch.column(2).cast(pa.binary())):
            n, keys = [], []
            for words in grouped_words(hasher, parts):
                n.append(len(words))
                keys.append([r.runs(words, len(words))[0] if len(words) else 0 for r in rolling])
            k = np.array(keys, np.uint64).view(np.int64)
            own = [batch.column(c).slice(first, len(parts)) for c in (0, 1)]
            yield pa.RecordBatch.from_arrays([*own, pa.array(n, pa.int64()), pa.array(k[:, 0].copy()), pa.array(k[:, 1].copy())], names=["doc_id", "key", "n_words", "k1", "k2"])


def _planes(x: np.ndarray) -> bytes:
    """Differences of int64, byte by byte, so that the shuffle's compression finds their zeros."""
    return np.ascontiguousarray(np.diff(x, prepend=np.int64(0)).view(np.uint8).reshape(-1, 8).T).tobytes()


def _unplaned(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).reshape(-1).view(np.int64))


def _address(hashes: np.ndarray, n_parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The part of the index that a hash belongs to, and its 32 bits there."""
    return (hashes % np.uint64(n_parts)).astype(np.int64), (hashes >> np.uint64(32)).astype(np.uint32)


def _sent(p: Params, n_parts: int):
    """Rows (part, blocks, probes, owners) of each piece of text; parts from `n_parts` on hold whole windows that two documents of the piece share."""

    def rows(doc_ids: list[int], words: list[np.ndarray], rolling: Rolling):
        hashes = [rolling.runs(w, p.block) for w in words]
        owner = np.repeat(np.array(doc_ids, np.int64), [len(h) for h in hashes])
        blocks = np.unique(np.concatenate([h[:: p.block] for h in hashes]))
        hashes = np.concatenate(hashes)
        order = np.lexsort((owner, hashes))
        hashes, owner = hashes[order], owner[order]
        same = np.concatenate(([False], hashes[1:] == hashes[:-1]))
        fresh = ~same | np.concatenate(([True], owner[1:] != owner[:-1]))
        hashes, owner, same = hashes[fresh], owner[fresh], same[fresh]
        shared = same | np.append(same[1:], False)
        # Shared within the piece: hits at once; only one of them goes on to meet other pieces.
        yield n_parts + doc_ids[0] % n_parts, None, hashes[shared], owner[shared]
        hashes, owner = hashes[~same], owner[~same]
        part, low = _address(hashes, n_parts)
        of_block, low_block = _address(blocks, n_parts)
        order = np.lexsort((owner, part))
        part, low, owner = part[order], low[order], owner[order]
        order = np.argsort(of_block, kind="stable")
        of_block, low_block = of_block[order], low_block[order]
        for k in np.unique(part):
            mine = slice(*np.searchsorted(part, [k, k + 1]))
            its = slice(*np.searchsorted(of_block, [k, k + 1]))
            yield int(k), low_block[its], low[mine], owner[mine]

    def run(batches):
        hasher, rolling = WordHasher(lower=False), Rolling()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, parts in text_groups(batch.column(2).cast(pa.binary()), p.chunk_bytes):
                words = [(i, w) for i, w in zip(ids[first : first + len(parts)], grouped_words(hasher, parts)) if len(w) >= p.window]
                if not words:
                    continue
                out = [(k, None if b is None else b.tobytes(), h.tobytes(), _planes(o)) for k, b, h, o in rows([i for i, _ in words], [w for _, w in words], rolling) if len(h)]
                kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
                for low in range(0, len(out), 512):
                    columns = zip(*out[low : low + 512])
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=["part", "blocks", "probes", "owners"])

    return run


def _hits(doc: np.ndarray, window: np.ndarray) -> pa.Table:
    """(doc_id, windows): the windows of each document."""
    order = np.argsort(doc, kind="stable")
    doc, window = doc[order], window[order]
    begins = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1]))) if len(doc) else np.zeros(0, np.int64)
    lists = pa.ListArray.from_arrays(pa.array(np.append(begins, len(doc)), pa.int32()), pa.array(window.view(np.int64)))
    return pa.Table.from_arrays([pa.array(doc[begins]), lists], names=["doc_id", "windows"])


def _named(part: np.ndarray | int, low: np.ndarray, n_parts: int) -> np.ndarray:
    """One number for what is known of a window: its part and its 32 bits there."""
    return low.astype(np.uint64) * np.uint64(n_parts) + np.asarray(part, np.int64).astype(np.uint64)


def _probed(n_parts: int):
    """One part of the index: the probing windows that are a block of some document and belong to more than one piece."""

    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        if part >= n_parts:
            found = [(np.frombuffer(h.as_py(), np.uint64), _unplaned(o.as_py())) for h, o in zip(table.column("probes"), table.column("owners"))]
            return _hits(np.concatenate([o for _, o in found]), np.concatenate([_named(*_address(h, n_parts), n_parts) for h, _ in found]))
        joined = lambda name: b"".join(x.as_py() for x in table.column(name))
        blocks, probes = np.unique(np.frombuffer(joined("blocks"), np.uint32)), np.frombuffer(joined("probes"), np.uint32)
        owners = np.concatenate([_unplaned(x.as_py()) for x in table.column("owners")])
        if not len(blocks):
            return _hits(np.zeros(0, np.int64), np.zeros(0, np.uint64))
        at = np.minimum(np.searchsorted(blocks, probes), len(blocks) - 1)
        hit = np.flatnonzero(blocks[at] == probes)
        at = at[hit]
        several = np.bincount(at, minlength=len(blocks)) > 1
        hit = hit[several[at]]
        return _hits(owners[hit], _named(part, probes[hit], n_parts))

    return run


def _extended(p: Params, n_parts: int):
    """(doc_id, key, place, h1, h2): the windows around the hits of each document, hashed to 128 bits."""

    def run(batches):
        hasher, rolling, second = WordHasher(lower=False), Rolling(), Rolling(0x5851F42D4C957F2D)
        for batch in batches:
            ids, keys, hits = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)
            for first, parts in text_groups(batch.column(2).cast(pa.binary())):
                out = [[], [], [], [], []]
                for k, words in enumerate(grouped_words(hasher, parts), first):
                    n = len(words) - p.window + 1
                    if n <= 0:
                        continue
                    mine = _named(*_address(rolling.runs(words, p.block), n_parts), n_parts)
                    hit = np.flatnonzero(np.isin(mine, hits[k].values.to_numpy().view(np.uint64)))
                    edge = np.zeros(n + 1, np.int64)
                    np.add.at(edge, np.minimum(np.maximum(hit - (p.window - p.block), 0), n), 1)
                    np.add.at(edge, np.minimum(hit + 1, n), -1)
                    place = np.flatnonzero(np.cumsum(edge)[:n] > 0)
                    h1, h2 = rolling.runs(words, p.window)[place], second.runs(words, p.window)[place]
                    for column, x in zip(out, (np.full(len(place), ids[k]), np.full(len(place), keys[k]), place.astype(np.int32), h1.view(np.int64), h2.view(np.int64))):
                        column.append(x)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=["doc_id", "key", "place", "h1", "h2"])

    return run


def _merged(window: int):
    """(doc_id, key, spans): windows that overlap or touch, as spans of words with the smallest document that holds one of them."""
    kind = pa.list_(pa.struct([("begins", pa.int32()), ("ends", pa.int32()), ("holder", pa.int64())]))

    def run(batches):
        for batch in batches:
            spans = []
            for found in batch.column(2):
                place, holder = (np.asarray(found.values.field(c)) for c in (0, 1))
                order = np.argsort(place, kind="stable")
                place, holder = place[order], holder[order]
                first = np.flatnonzero(np.concatenate(([True], place[1:] > place[:-1] + window)))
                last = np.append(first[1:], len(place)) - 1
                own = zip(place[first].tolist(), (place[last] + window).tolist(), np.minimum.reduceat(holder, first).tolist())
                spans.append([{"begins": a, "ends": b, "holder": c} for a, b, c in own])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, kind)], names=["doc_id", "key", "spans"])

    return run


def repeats(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """(doc_id, key, spans, whole): for each text that repeats one of a smaller doc_id, the spans of its words that do.

    A span (begins, ends, holder) is a maximal run of words covered by windows of `window` words whose sequence also starts in a document with
    a smaller doc_id; holder is the smallest such document. `key` is xxhash64 of the text, for doc_ids with several texts. Where the whole word
    sequence is that of a smaller doc_id, `whole` is true and spans is null. Words are runs without ASCII white space, case and all. Texts
    under one doc_id do not repeat each other; null doc_ids neither repeat nor are repeated; texts shorter than a window have no repeat. Other
    columns are ignored; an empty table gives an empty result.

    Every document's non-overlapping blocks of half a window are indexed, and every rolling window of that size probes them. Both travel as packed
    arrays of a piece of text for each part of the index, windows that a piece holds more than once only once, so that a passage in most documents
    costs one entry of a piece. A hit is a block that some other piece or document holds; the windows around it are then compared by
    128-bit hashes with the smallest document that holds them (partial minima, joined back), and those that stand are merged to maximal
    repeats. So no pair of documents is made, however many share a passage. The number of parts follows the bytes of text.
    """
    p, spark = params, docs.sparkSession
    keyed = _keyed(docs.where("doc_id is not null"))
    size = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // p.part_bytes))

    signed = materialise(keyed.mapInArrow(_signed, "doc_id long, key long, n_words long, k1 long, k2 long"), "signed")
    same = signed.where(F.col("n_words") >= p.window)
    copies = materialise(same.groupBy("k1", "k2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last"), "copies")
    judged = materialise(same.join(copies, ["k1", "k2"], "left").select("doc_id", "key", (F.col("doc_id") > F.coalesce("first", "doc_id")).alias("whole")), "copied")
    whole = judged.where("whole").select("doc_id", "key").distinct()

    sent = keyed.mapInArrow(_sent(p, n_parts), "part int, blocks binary, probes binary, owners binary")
    hits = sent.groupBy("part").applyInArrow(_probed(n_parts), "doc_id long, windows array<long>")
    hits = hits.join(judged.where("not whole").select("doc_id").distinct(), "doc_id", "left_semi")
    hits = materialise(hits.groupBy("doc_id").agg(F.flatten(F.collect_list("windows")).alias("windows")), "hits")

    texts = rows_within(keyed, "doc_id", hits.select("doc_id"), "doc_id").join(hits, "doc_id").select("doc_id", "key", "text", "windows")
    around = materialise(texts.mapInArrow(_extended(p, n_parts), "doc_id long, key long, place int, h1 long, h2 long"), "windows")
    held = around.groupBy("h1", "h2").agg(F.min("doc_id").alias("holder"), F.max("doc_id").alias("last")).where("holder < last")
    held = materialise(held.select("h1", "h2", "holder"), "held")
    repeated = around.join(held, ["h1", "h2"]).where("doc_id > holder")
    gathered = repeated.groupBy("doc_id", "key").agg(F.collect_list(F.struct("place", "holder")).alias("found"))
    kind = "array<struct<begins:int,ends:int,holder:bigint>>"
    spans = gathered.mapInArrow(_merged(p.window), f"doc_id long, key long, spans {kind}")
    both = spans.withColumn("whole", F.lit(False)).union(whole.select("doc_id", "key", F.expr(f"cast(null as {kind})"), F.lit(True)))
    found = both.groupBy("doc_id", "key").agg(F.max("spans").alias("spans"), F.max("whole").alias("whole"))
    return found.select("doc_id", "key", F.when(~F.col("whole"), F.col("spans")).alias("spans"), "whole")


def _cut(batches):
    """(doc_id, n_words, n_removed, kept) of rows (doc_id, text, spans, whole)."""
    for batch in batches:
        n, removed, kept = [], [], []
        for text, spans, whole in zip(batch.column(1).cast(pa.binary()), batch.column(2), batch.column(3)):
            words, gone = text.as_py().split(), 0
            n.append(len(words))
            if whole.as_py():
                words, gone = [], len(words)
            for s in reversed(spans.as_py() or []):
                del words[s["begins"] : s["ends"]]
                gone += s["ends"] - s["begins"]
            removed.append(gone)
            kept.append(b" ".join(words).decode())
        columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept"])


def without_repeats(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for each row of `docs`: the text without the words of `repeats`, the others joined by one space.

    A null text has no words. Every row is returned, repeated rows too, which lose the same words.
    """
    p = params
    found = materialise(repeats(docs, p), "repeats")
    touched, spans = found.agg(F.count("*"), F.sum(F.coalesce(F.size("spans"), F.lit(0)))).first()
    few = touched <= p.most_sent and (spans or 0) <= 2 * p.most_sent
    found = found.withColumnRenamed("doc_id", "of").withColumnRenamed("key", "of_key")
    own = _keyed(docs)
    met = own.join(F.broadcast(found) if few else found, (F.col("doc_id") == F.col("of")) & (F.col("key") == F.col("of_key")), "left")
    return met.select("doc_id", "text", "spans", F.coalesce("whole", F.lit(False)).alias("whole")).mapInArrow(_cut, "doc_id long, n_words long, n_removed long, kept string")


REPEATS_SQL = r"""
WITH worded AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w FROM documents),
places AS (SELECT row, doc_id, w, unnest(range(1, len(w) - 48)) AS k FROM worded WHERE len(w) >= 50),
windows AS (SELECT row, doc_id, k, md5(array_to_string(w[k:k + 49], ' ')) AS h FROM places),
firsts AS (SELECT h, min(doc_id) AS first FROM windows GROUP BY h),
covered AS (SELECT DISTINCT row, unnest(range(k, k + 50)) AS k FROM windows JOIN firsts USING (h) WHERE doc_id > first),
left_over AS (SELECT row, w[k] AS word, k FROM (SELECT row, w, unnest(range(1, len(w) + 1)) AS k FROM worded) ANTI JOIN covered USING (row, k)),
kept AS (SELECT row, count(*) AS n, string_agg(word, ' ' ORDER BY k) AS text FROM left_over GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM worded LEFT JOIN kept USING (row)
"""
