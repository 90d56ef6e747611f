"""The ten operators and the pipeline against brute force, their SQL, and their defined edge cases."""

import collections
import itertools
import math
import re
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from fieldloom.llm import chat, common, components, graph_search, licences, mixing, near_duplicates, quality_rules, registry, sentencepiece, sharding, toxicity, url_filter

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from oracle import compare  # noqa: E402

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, h string, rep long, u string"


def docs(spark, texts):
    """Documents with extra columns whose names clash with internal ones."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", 1, "y") for i, t in texts], DOCS)


EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (7, "é" * 30), (8, "word " * 20000), (9, "x" * 60000)]


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql_twin(spark, name):
    assert compare(registry.queries()[name](spark, SF), registry.oracle_sql()[name], SF) == ""


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute_components(texts, percent=75):
    sets = {i: shingles(t) for i, t in texts}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {i: root(i) for i in sets}, {i: len(s) for i, s in sets.items()}


def edited(rng, words, n):
    words = list(words)
    for k in rng.integers(0, len(words), n):
        words[k] = f"z{rng.integers(1 << 30)}"
    return " ".join(words)


def test_near_duplicates_match_brute_force(spark):
    rng = np.random.default_rng(1)
    texts = []
    for _ in range(12):
        base = [f"w{rng.integers(5000)}" for _ in range(int(rng.integers(8, 160)))]
        texts += [edited(rng, base, int(rng.integers(0, 7))) for _ in range(12)]
    shared = " ".join(f"p{k}" for k in range(60))
    texts += [shared + " " + " ".join(f"q{rng.integers(10**6)}" for _ in range(int(rng.integers(5, 60)))) for _ in range(60)]
    rows = list(enumerate(texts, 10)) + [(3, None), (4, ""), (5, "One two"), (6, "one  TWO")]
    got = near_duplicates.near_duplicates(docs(spark, rows)).collect()
    component, size = brute_components(rows)
    assert {r.doc_id: r.component_id for r in got} == component
    assert {r.doc_id: r.n_shingles for r in got} == size
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_over_the_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert {r.doc_id: r.component_id for r in registry.op3_near_duplicates(spark, SF).collect()} == brute_components(rows)[0]


def test_near_duplicates_edges(spark):
    got = near_duplicates.near_duplicates(docs(spark, EDGES)).collect()
    assert len(got) == len(EDGES)
    by = collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert [r.component_id for r in by[5]] == [5, 5] and by[None][0].component_id is None and by[None][0].kept
    assert by[1][0].n_shingles == by[2][0].n_shingles == by[3][0].n_shingles == 0 and by[8][0].n_shingles == 1
    assert near_duplicates.near_duplicates(docs(spark, [])).count() == 0


def test_components_of_chains_and_hubs(spark):
    edges = [(k, k + 1) for k in range(0, 50)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {k: 0 for k in range(51)} | {k: 100 for k in range(100, 160)}


def test_shards_by_bytes(spark):
    got = registry.op5_byte_shards(spark, SF).orderBy("doc_id").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    total, begins, slots = sum(len(t.encode()) + 1 for t in texts.values()), 0, collections.Counter()
    for r in got:
        assert r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) and r.size == len(texts[r.doc_id].encode()) + 1
        assert r.shard == begins * 16 // total and r.slot == slots[r.shard]
        slots[r.shard] += 1
        begins += r.size
    assert len(got) == len(texts)


def test_shards_edges(spark, tmp_path):
    got = sharding.byte_shards(docs(spark, EDGES), 4).collect()
    assert len(got) == len(EDGES) and min(r.size for r in got) == 1
    assert sharding.byte_shards(docs(spark, []), 4).count() == 0
    sharding.write_shards(docs(spark, EDGES).select("doc_id", "text"), str(tmp_path / "out"), 2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(EDGES) and set(back.columns) == {"doc_id", "text", "slot", "shard"}
    odd = spark.createDataFrame([(1, "same", "en", "a", 9), (1, "same", "de", "b", 8), (None, None, "fr", "c", 7)], "doc_id long, text string, lang string, source string, slot long")
    sharding.write_shards(odd, str(tmp_path / "odd"), 2)
    got = sorted(spark.read.parquet(str(tmp_path / "odd")).select("doc_id", "text", "lang", "source", "doc_slot").collect(), key=lambda r: r.lang)
    assert [tuple(r) for r in got] == [(1, "same", "de", "b", 8), (1, "same", "en", "a", 9), (None, None, "fr", "c", 7)]


def test_graph_search_recall(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(10, 32))
    x = (centres[rng.integers(0, 10, 900)] + rng.normal(size=(900, 32))).astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    p = graph_search.Params(shard_rows=300)
    got = graph_search.nearest(df, F.col("vec_id") % 20 == 0, p).collect()
    y = x.astype(np.float64)
    hits = 0
    found = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found[r.query_id].append((r.score, r.vec_id))
    for q in range(0, 900, 20):
        d = np.sqrt(((y - y[q]) ** 2).sum(axis=1))
        true = [(d[k], k) for k in np.lexsort((np.arange(900), d)) if k != q][:10]
        assert found[q] == sorted(found[q]) and all(math.isclose(s, d[k], rel_tol=1e-12) for s, k in found[q])
        hits += len({k for _, k in true} & {k for _, k in found[q]})
    assert hits / (45 * 10) >= 0.95


def test_graph_search_edges(spark):
    same = [(k, [1.0, 2.0], 0) for k in range(100, 140)]
    odd = [(1, None, 0), (2, [0.0, 0.0], 0), (3, [1.0, None], 0), (4, [float("nan"), 1.0], 0), (5, [float("inf"), 1.0], 0), (6, [], 0), (7, [3.0, 2.0], 0), (7, [3.0, 2.0], 0), (8, [1.0, 1.0, 1.0], 0)]
    df = spark.createDataFrame(same + odd, "vec_id long, embedding array<float>, label int")
    got = graph_search.nearest(df, F.col("vec_id").isin(100, 1, 2, 3, 7, 8)).collect()
    by = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: r.rank):
        by[r.query_id].append(r.vec_id)
    assert by == {100: list(range(101, 111)), 7: list(range(100, 110))}
    assert graph_search.nearest(df.limit(0), F.lit(True)).count() == 0


def test_graph_search_folds_repeated_rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 8)).astype(np.float32)
    x[40:] = x[39]
    once = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").coalesce(1)
    df = once.union(once)
    for _ in range(12):
        df = df.union(once.where("vec_id = 39"))
    by = collections.defaultdict(list)
    for r in sorted(graph_search.nearest(df, F.lit(True)).collect(), key=lambda r: r.rank):
        by[r.query_id].append(r.vec_id)
    y = x.astype(np.float64)
    for q in range(60):
        d = np.sqrt(((y - y[q]) ** 2).sum(axis=1))
        assert by[q] == [k for k in np.lexsort((np.arange(60), d)).tolist() if k != q][:10]


def test_graph_search_over_many_regions(spark):
    rng = np.random.default_rng(12)
    x = (rng.normal(size=(20, 16))[rng.integers(0, 20, 2000)] * 3 + rng.normal(size=(2000, 16))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    p = graph_search.Params(shard_rows=50, probes=12, query_block=30)
    index = graph_search.build_index(df, p)
    assert index.shards.count() >= 40 and len(index.pivots[16]) > p.probes
    found = collections.defaultdict(set)
    for r in graph_search.nearest(df, F.col("vec_id") % 20 == 0, p).collect():
        found[r.query_id].add(r.vec_id)
    y, hits = x.astype(np.float64), 0
    for q in range(0, 2000, 20):
        d = ((y - y[q]) ** 2).sum(axis=1)
        hits += len(found[q] & {k for k in np.argsort(d, kind="stable")[:11].tolist() if k != q})
    assert hits / 1000 >= 0.9


def test_graph_search_finds_an_id_with_several_vectors_once(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [1.0, 0.05]), (3, [5.0, 5.0]), (4, [1e200, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r.rank, r.vec_id) for r in graph_search.nearest(df, F.col("vec_id") != 4).collect())
    assert got == [(1, 1, 2), (1, 2, 3), (1, 3, 4), (2, 1, 1), (2, 2, 3), (2, 3, 4), (3, 1, 2), (3, 2, 1), (3, 3, 4)] or got[6:8] == [(3, 1, 1), (3, 2, 2)]


@pytest.fixture(scope="module")
def vocabulary():
    return sentencepiece.load_vocabulary(registry.VOCABULARY)


def best_score(text, pieces, score):
    """The best sum over all ways to cut a text into pieces."""
    if not text:
        return 0.0
    return max((score[pieces[text[:k]]] + best_score(text[k:], pieces, score) for k in range(1, len(text) + 1) if text[:k] in pieces), default=-math.inf)


def test_viterbi_is_the_best_segmentation(vocabulary):
    import sentencepiece as library

    model = open(registry.VOCABULARY, "rb").read()
    at = model.rindex(b"\x18\x02 \x80\xfa\x01")
    reader = library.SentencePieceProcessor(model_proto=model[:at] + b"\x18\x01" + model[at + 2 :])  # the same pieces as a unigram model
    encoder = sentencepiece.Encoder(vocabulary)
    for text in ["other", "the of", "Straße über", "日本語 x", "a  b", "internationalisation", "x\ny"]:
        assert encoder.encode([text])[0] == reader.nbest_encode_as_ids(text, nbest_size=4)[0]
    score = dict(zip(vocabulary.ids.tolist(), vocabulary.scores.tolist()))
    pieces = dict(zip(vocabulary.pieces, vocabulary.ids.tolist()))
    rng = np.random.default_rng(4)
    for _ in range(40):
        word = "".join(rng.choice(list("etaoin"), int(rng.integers(1, 8))))
        got = encoder.encode([word])[0]
        assert math.isclose(sum(score[i] for i in got), best_score("▁" + word, pieces, score))
    long = "etaoin" * 120
    assert encoder.viterbi_in_blocks(["▁" + long])[0] == encoder.viterbi(["▁" + long])[0]


@pytest.mark.parametrize("block", [1, 500, 4000, 1 << 18])
def test_long_words_in_blocks(vocabulary, block):
    """Whatever the blocks, the same pieces as by the matrix of all positions; characters outside the vocabulary, runs and surrogate pairs included."""
    encoder, rng = sentencepiece.Encoder(vocabulary), np.random.default_rng(block)
    for letters in ("etaoinshrdlu", "aaaaab", "日本語ß😀\x01x", "AbC019+/="):
        for n in (1, 2, 15, 16, 17, 33, 700):
            words = ["▁" + "".join(rng.choice(list(letters), n)) for _ in range(3)]
            assert encoder.viterbi_in_blocks(words, block) == encoder.viterbi(words)


def test_long_words_are_not_remembered(vocabulary):
    import tracemalloc

    encoder, peaks = sentencepiece.Encoder(vocabulary), []
    for n in (4_000, 12_000):
        text = "x1Yz" * n + " short"
        tracemalloc.start()
        tokens = encoder.encode([text])[0]
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert sentencepiece.Decoder(vocabulary).decode(tokens) == text
    assert set(encoder.cache) == {"short"}
    assert peaks[1] - peaks[0] < 60 * 4 * 8_000  # beside blocks of one size, so many bytes for each more character


def test_a_hash_alone_is_no_match(vocabulary):
    """A piece whose key is made to be that of another string is not found in it."""
    encoder = sentencepiece.Encoder(vocabulary)
    whole = encoder.viterbi(["▁the"])[0]
    encoder.letters[:, 0] ^= np.uint64(1)
    assert len(whole) < len(encoder.viterbi(["▁the"])[0])


def test_tokens_round_trip(spark, vocabulary):
    texts = EDGES + [(20, "  two  spaces \n▁ mark ▁▁"), (21, "日本 😀 ß\x00\x01"), (22, " "), (23, "a" * 1000 + "é " * 50)]
    got = sentencepiece.encode(docs(spark, texts), vocabulary)
    assert got.where("exact = false").count() == 0 and got.count() == len(texts)
    assert got.where("tokens is null").count() == 1 and got.where("text is null" if "text" in got.columns else "doc_id = 1").first().n_tokens == 0
    back = sentencepiece.decode(got, vocabulary).where("doc_id >= 20").orderBy("doc_id").collect()
    assert [r.text for r in back] == [t for i, t in texts if i and i >= 20]
    assert sentencepiece.encode(docs(spark, []), vocabulary).count() == 0


def brute_compression(data, limits):
    """The bands read anew: a whole text, and pieces of 4096 bytes with the last one by its own length."""
    if not data:
        return True

    def bad(piece, bands):
        low, high = [(a, b) for most, a, b in bands if len(piece) < most][0]
        ratio = len(piece) / len(zstandard.ZstdCompressor(level=3).compress(piece))
        return ratio < low or ratio > high

    pieces = [data[k : k + 4096] for k in range(0, len(data), 4096)]
    return not bad(data, limits.bands) and sum(len(p) for p in pieces if bad(p, limits.chunk_bands)) <= 0.2 * len(data)


def brute_quality(text):
    text = text or ""
    words = text.encode().split()
    counts = collections.Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    covered = {j for k in range(len(words) - 4) if counts[tuple(words[k : k + 5])] > 1 for j in range(k, k + 5)}
    lines = [x for x in text.split("\n") if x.strip(" \t\n\r\x0b\x0c")]
    return len(words), sum(len(w.decode()) for w in words), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_quality_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + [(10**6 + k, t) for k, (_, t) in enumerate(EDGES)]
    rows += [(10**7, "a b c d e a b c d e f\na\n a\na\x0b\n\n # *|<>")]
    limits = quality_rules.Limits()
    texts = dict(rows)
    for r in quality_rules.quality(docs(spark, rows)).collect():
        want = brute_quality(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert r.kept == (not r.base_failed and brute_compression((texts[r.doc_id] or "").encode(), limits))


def test_quality_keeps_prose_and_rejects_noise():
    rng = np.random.default_rng(6)
    packer, limits = zstandard.ZstdCompressor(level=3), quality_rules.Limits()
    prose = " ".join(rng.choice(["the", "of", "house", "river", "stone", "green", "walk", "ending", "mountain", "early"], 40)) + " " + " ".join("".join(rng.choice(list("etaoinshr"), 6)) for _ in range(300))
    noise = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"), 6000))
    assert quality_rules.compression_verdict(packer, prose.encode(), limits)[2]
    assert not quality_rules.compression_verdict(packer, noise.encode(), limits)[2]
    assert not quality_rules.compression_verdict(packer, b"buy now " * 400, limits)[2]
    assert quality_rules.compression_verdict(packer, b"", limits)[2]
    tail = prose.encode()[:4000] + b"buy now " * 180  # under half a piece, and judged
    assert len(tail) < 6144 and not quality_rules.compression_verdict(packer, tail, limits)[2] and not brute_compression(tail, limits)


def test_quality_edges(spark):
    frame = docs(spark, []).withColumn("__q_kept", F.lit(1))
    assert quality_rules.quality(frame).count() == 0 and quality_rules.with_quality(frame).columns.count("__q_kept") == 1


def test_toxicity_is_learnt_outside_the_held_out_fold(spark):
    rng = np.random.default_rng(7)
    plain = ["".join(rng.choice(list("etaoinshrdl"), 6)) for _ in range(400)]
    rows, labels = [], []
    for k in range(900):
        words = list(rng.choice(plain, 60))
        if toxic := k % 9 == 0:
            words[:3] = rng.choice(["grubbler", "grubbling", "snarkoff"], 3)
        rows.append((k, " ".join(words)))
        if k % 2 == 0 or toxic:
            labels.append((k, int(toxic)))
    frame = docs(spark, rows)
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(frame, known).collect()}
    held = [k for k in range(900) if zlib.crc32(str(k).encode()) % 3 == 1]
    assert {k for k, r in got.items() if r.held_out} == set(held)
    assert sum(got[k].predicted for k in held if k % 9 == 0) >= 0.9 * sum(k % 9 == 0 for k in held)
    assert sum(got[k].predicted for k in held if k % 9) <= 0.02 * len(held)
    flipped = spark.createDataFrame([(i, 1 - t if i in set(held) else t) for i, t in labels], "doc_id long, toxic int")
    again = {r.doc_id: r.score for r in toxicity.toxicity(frame, flipped).collect()}
    assert again == {k: r.score for k, r in got.items()}


def brute_score(text, model):
    words = (text or "").encode().lower().split()
    held = {w + b" " for w in words} | {w[:n] for w in words for n in (4, 5, 6, 7) if len(w) >= n}
    total = model.bias + sum(model.weights[k] for w, k in model.numbers.items() if w in held)
    return 1 / (1 + math.exp(-max(-30, min(30, total))))


def test_toxicity_scores_are_those_of_a_plain_sum(spark):
    texts = [t for _, t in EDGES] + ["Stemming STEMS stem", "stemmed\x0bword\nöst östlich"] + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(40).collect()]
    known = sorted({w for t in texts[-40:] for w in t.encode().lower().split() if len(w) > 7})
    rng = np.random.default_rng(13)
    features = [b"stem", b"stem ", b"stemme", "öst".encode()[:4], *(w[:5] for w in known[:300:3]), *(w + b" " for w in known[1:300:3])]
    model = toxicity.Model({w: k for k, w in enumerate(dict.fromkeys(features))}, rng.normal(size=len(set(features))), -0.5)
    got = {r.doc_id: r["__toxicity"] for r in toxicity.with_scores(docs(spark, list(enumerate(texts))), model).collect()}
    assert all(math.isclose(got[k], brute_score(t, model), rel_tol=1e-9) for k, t in enumerate(texts))


def test_toxicity_takes_conflicting_labels_as_toxic(spark):
    frame = docs(spark, [(k, f"{'plain' if k % 6 else 'foul'} rest of it n{k}x") for k in range(240)])
    labels = spark.createDataFrame([(k, t) for k in range(240) for t in ((0,) if k % 6 else (0, 1))], "doc_id long, toxic int")
    got = toxicity.toxicity(frame, labels).collect()
    assert all(r.predicted == (r.doc_id % 6 == 0) for r in got)


def test_toxicity_edges(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.toxicity(docs(spark, EDGES), none).collect()
    assert len(got) == len(EDGES) and all(0 <= r.score < 0.7 and r.predicted == 0 for r in got)
    assert toxicity.toxicity(docs(spark, []), spark.createDataFrame([(1, 1)], "doc_id long, toxic int")).count() == 0


def test_non_negative_risk_beats_its_floor():
    rng = np.random.default_rng(8)
    pos = [[0] + rng.integers(2, 30, 4).tolist() for _ in range(60)]
    unl = [([0] if k % 5 == 0 else [1]) + rng.integers(2, 30, 4).tolist() for k in range(300)]
    w, b = toxicity.fit_nnpu(toxicity.Presence(pos, 30), toxicity.Presence(unl, 30), 0.2, toxicity.Params())
    assert w[0] > 1 and w[0] > w[1] and np.isfinite(w).all() and b < 0


def test_url_rules(spark):
    urls = ["http://www.EXAMPLE.com/en/x", "http://example.com/en/", "https://a.example.com/en/1?q", "http://example.com", "http://notexample.com/en/", "https://b.net/fr/1", "http://evil.org/x.example.com/en/y", "http://x.org/a.zip", "http://x.org/a.zip.html", "http://ads.x.org/", None, "no scheme", "://", "http://h.org/?utm_a=b#c", "http://h.org#/login", "ftp://net/es/", "http://x.org/" + "y" * 3000 + "/login"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("clash"))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.url_verdicts(pages, registry.HOST_RULES, url_filter.DEFAULT_GLOBS).collect()}
    rules = {0: ("www.example.com/en/", "allow"), 1: ("example.com/en/", "block"), 2: ("example.com/en/", "block"), 3: (None, "allow"), 4: ("com/", "allow"), 5: ("net/fr/", "block"), 6: (None, "allow"), 7: (None, "block"), 8: (None, "allow"), 9: (None, "block"), 10: (None, "allow"), 11: (None, "allow"), 12: (None, "allow"), 13: (None, "block"), 14: (None, "allow"), 15: ("net/es/", "block"), 16: (None, "block")}
    assert {k: v[2:] for k, v in got.items()} == rules
    assert got[0][:2] == ("www.example.com", "/en/x") and got[10][:2] == ("", "") and got[13][:2] == ("h.org", "/")
    assert url_filter.url_verdicts(pages.limit(0), registry.HOST_RULES, []).count() == 0


def test_globs_match_fnmatch():
    import fnmatch

    rng = np.random.default_rng(9)
    globs = ["".join(rng.choice(list("ab*?"), int(rng.integers(1, 9)))) for _ in range(40)]
    texts = ["".join(rng.choice(list("ab"), int(rng.integers(0, 12)))) for _ in range(60)]
    automaton = url_filter.ShiftAnd([url_filter._glob_pattern(url_filter.GlobRule("block", g)) for g in globs], [True] * 40)
    assert automaton.words > 1
    hit = automaton.run([t.encode() for t in texts])
    assert hit.tolist() == [[fnmatch.fnmatchcase(t, g) for g in globs] for t in texts]


def test_licences(spark):
    mit = licences.TEMPLATES["MIT"][1]
    rows = EDGES + [(30, "words before\nReleased under the MIT License.\nafter"), (31, mit.replace(",", ",\n")), (32, "intro\n\n" + mit.replace(". ", ".\n") + "\n\nend"), (33, "Released under the licence of nobody at all"), (34, "RELEASED under - the mit license"), (34, "RELEASED under - the mit license")]
    got = {(r.doc_id, r.unit, r.licence) for r in licences.licence_scan(docs(spark, rows)).collect()}
    assert got == {(30, "line", "MIT"), (31, "text", "MIT"), (32, "line", "MIT"), (32, "block", "MIT"), (32, "text", "MIT"), (34, "line", "MIT")} | {(k, "passage", "MIT") for k in (30, 31, 32, 34)}
    assert licences.licence_scan(docs(spark, [])).count() == 0


def test_licences_inside_other_text(spark):
    bsd = licences.TEMPLATES["BSD-2-Clause"][0].replace("met: ", "met:\n\n").replace("disclaimer. ", "disclaimer.\n\n", 1)
    apache = licences.TEMPLATES["Apache-2.0"][1].split()
    wrapped = "\n".join(" ".join(apache[k : k + 9]) for k in range(0, len(apache), 9))
    other = " ".join(f"w{k}" for k in range(700))
    rows = [
        (1, f"{other}\n\n{bsd}\n\n{other}"),
        (2, "We hope this helps you. Released under the MIT Licence. Thank you."),
        (3, f"words directly above\n{wrapped}\nwords directly below " + other),
        (4, other),
        (5, f"{other} {bsd} {other} {bsd}"),
    ]
    got = {(r.doc_id, r.position, r.licence, r.dice) for r in licences.licence_scan(docs(spark, rows)).where("unit = 'passage'").collect()}
    again = 1400 + len(re.findall(r"[^\W_]+", bsd))
    assert got == {(1, 700, "BSD-2-Clause", 1.0), (2, 5, "MIT", 1.0), (3, 3, "Apache-2.0", 1.0), (5, 700, "BSD-2-Clause", 1.0), (5, again, "BSD-2-Clause", 1.0)}


def passages_by_brute_force(text, template, least):
    """(first word, coefficient) of the best of the runs that overlap; every first and last word is tried."""
    grams, wanted = (list(zip(x.split(), x.split()[1:])) for x in (text, template))
    known, runs = collections.Counter(wanted), []
    for a in range(len(grams)):
        best, own, shared = None, collections.Counter(), 0
        for b in range(a, len(grams)):
            own[grams[b]] += 1
            shared += own[grams[b]] <= known[grams[b]]
            dice = 2 * shared / (b - a + 1 + len(wanted))
            if best is None or dice > best[0]:
                best = dice, b
        if best[0] >= least:
            runs.append((a, best[1], best[0]))
    out, reached, now = [], -1, []
    for a, b, dice in runs:
        if a > reached and now:
            out.append(min(now))
            now = []
        now.append((-dice, a))
        reached = max(reached, b)
    return [(a, -d) for d, a in (out + [min(now)] if now else out)]


def test_passages_equal_all_runs(spark):
    """Random words over a small vocabulary, against every run of words counted by itself."""
    rng, least = np.random.default_rng(21), 0.6
    template = " ".join(rng.choice(list("abcdef"), 24))
    texts = {k: " ".join([*rng.choice(list("abcdef"), int(rng.integers(0, 60))), *(template.split()[: 12 + k] if k % 2 else [])]) for k in range(60)}
    want = {(k, a, round(d, 9)) for k, t in texts.items() for a, d in passages_by_brute_force(t, template, least)}
    got = licences.licence_scan(docs(spark, list(texts.items())), {"T": [template]}, least).where("unit = 'passage'").collect()
    assert {(r.doc_id, r.position, round(r.dice, 9)) for r in got} == want and len(want) > 30


def test_no_changed_notice_is_lost(spark):
    """Notices with words replaced, lost and added, at any place of other text: each that still reaches the coefficient is found where it is, and as good."""
    rng = np.random.default_rng(12)
    template = licences.TEMPLATES["MPL-2.0"][0]
    plain = " ".join(re.findall(r"[^\W_]+", template.lower()))
    texts, likeness = {}, {}
    for k in range(400):
        notice = plain.split()
        for _ in range(int(rng.integers(2, 5))):
            at = int(rng.integers(len(notice)))
            notice[at : at + int(rng.integers(0, 3))] = [f"z{rng.integers(1000)}" for _ in range(int(rng.integers(0, 3)))]
        known, own = (collections.Counter(zip(x, x[1:])) for x in (plain.split(), notice))
        likeness[k] = 2 * sum((known & own).values()) / (sum(known.values()) + sum(own.values()))
        around = [[f"y{rng.integers(10**6)}" for _ in range(int(rng.integers(0, 90)))] for _ in range(2)]
        texts[k] = (len(around[0]), len(notice), " ".join([*around[0], *notice, *around[1]]))
    found = {r.doc_id: r for r in licences.licence_scan(docs(spark, [(k, t) for k, (_, _, t) in texts.items()])).where("unit = 'passage' and licence = 'MPL-2.0'").collect()}
    good = [k for k, d in likeness.items() if d >= 0.8]
    assert len(good) > 150
    assert all(k in found and found[k].dice >= likeness[k] - 1e-9 and texts[k][0] <= found[k].position < texts[k][0] + texts[k][1] for k in good)


def test_no_template_is_reached_without_an_anchor_word():
    rows = licences.template_rows(licences.TEMPLATES, 0.8)
    words = set(licences.anchor_words(rows))
    for key in {r[:5] for r in rows}:
        assert sum(r[6] for r in rows if r[:5] == key and not words & set(r[5].split())) < key[3]


def test_licences_break_ties_by_name(spark):
    same = "free for any use whatsoever by anyone"
    got = licences.licence_scan(docs(spark, [(1, same)]), {"B": [same], "A": [same]}).collect()
    assert sorted((r.unit, r.licence) for r in got) == [("line", "A"), ("passage", "A"), ("passage", "B")]


def test_raking_meets_the_targets(spark):
    rng = np.random.default_rng(10)
    cells = spark.createDataFrame([(s, l, int(rng.integers(50, 500))) for s in ("a", "b", None) for l in ("x", "y")], "source string, lang string, tokens long")
    targets = mixing.Targets({"source": {"a": 0.5, "b": 0.2}, "lang": {"x": 0.7, "y": 0.3}})
    raked = mixing.rake(cells, targets).collect()
    for d, v, want in [("source", "a", 0.5), ("source", "b", 0.2), ("source", None, 0.3), ("lang", "x", 0.7), ("lang", "y", 0.3)]:
        assert math.isclose(sum(r.weight for r in raked if r[d] == v), want, rel_tol=1e-6)


def test_raking_says_when_it_does_not_settle(spark):
    cells = spark.createDataFrame([("a", "x", 10), ("b", "y", 10)], "source string, lang string, tokens long")
    targets = {"source": {"a": 0.5, "b": 0.5}, "lang": {"x": 0.9, "y": 0.1}}
    with pytest.warns(UserWarning, match="did not settle"):
        mixing.rake(cells, mixing.Targets(targets, rounds=3))
    with pytest.raises(RuntimeError, match="did not settle"):
        mixing.rake(cells, mixing.Targets(targets, rounds=3, strict=True))


def test_topics_are_read_from_whole_texts(spark):
    rows = [(1, "Is this in on at"), (2, "x " * 5000 + "MIT Mit für"), (3, "is in"), (4, "island, inn"), (5, None), (6, "in, is")]
    got = {r.doc_id: r["__topic"] for r in mixing.with_topics(docs(spark, rows).withColumn("__topic", F.lit("x")), registry.TOPICS).collect()}
    assert got == {1: "place", 2: "relation", 3: "being", 4: None, 5: None, 6: "being"}


def test_sampled_tokens_meet_the_targets(spark):
    rng = np.random.default_rng(14)
    rows = [(k, " ".join(rng.choice(["is", "in", "to", "word", "other"], int(rng.integers(20, 60))))) for k in range(24000)]
    frame = docs(spark, rows).withColumn("source", F.concat(F.lit("src"), (F.col("doc_id") % 20).cast("string"))).withColumn("lang", F.element_at(F.array(*map(F.lit, ("en", "en", "de", "fr", "es"))), (F.pmod(F.xxhash64("doc_id"), F.lit(5)) + 1).cast("int")))
    kept = registry.mixed(frame).where("__draw < __cut").select("__tokens", "__cell.*").toPandas()
    for d, shares in registry.MIX.shares.items():
        got = kept.groupby(d)["__tokens"].sum() / kept["__tokens"].sum()
        given = {v: w for v, w in shares.items() if v in got}
        for v, w in given.items():
            assert abs(got[v] - w / sum(given.values())) < 0.004, (d, v)


def test_sampled_tokens_of_the_real_table_meet_the_targets(spark):
    """Of 10,000 documents, of which the longest holds a fiftieth of what is kept: each named class is within a point of its share."""
    out = registry.op2_mix_sources(spark, "/root/testdata/sf0.1").where("kept").toPandas()
    for d, name in (("source", "source_class"), ("lang", "lang_class"), ("topic", "topic")):
        shares = registry.MIX.shares[d]
        got = out.groupby(name, dropna=False)["n_tokens"].sum() / out["n_tokens"].sum()
        rest = 1 - sum(shares.values()) if got.index.isna().any() else 0.0  # a class that there is none of gives its share to the others
        for v, w in shares.items():
            assert abs(got[v] - w / (sum(shares.values()) + rest)) < 0.01, (d, v, got[v])


def test_cuts_take_a_cells_share_in_order_of_draws(spark):
    """Against a plain walk: equal draws, documents without tokens, quotas of nothing, of all, and of half a document."""
    rng = np.random.default_rng(16)
    rows = [(c, int(d), int(t)) for c in ("a", "b", None, "d") for d, t in zip(rng.integers(0, 1 << 32, 300), rng.integers(0, 40, 300))]
    rows += [("a", 7, 5), ("a", 7, 5), ("a", 7, 0), ("one", 1 << 31, 10)]
    quotas = {"a": 2500.0, "b": 0.0, None: float(sum(t for c, _, t in rows if c is None)), "d": 77.5, "one": 5.0}
    df = spark.createDataFrame(rows, "c string, draw long, tokens long")
    counts = df.groupBy("c", F.shiftright("draw", 20).alias("bucket")).agg(F.sum("tokens").alias("tokens"))
    got = {r.c: r["__cut"] for r in mixing.cuts(df, counts, spark.createDataFrame(list(quotas.items()), "c string, quota double"), ["c"]).collect()}
    for c, quota in quotas.items():
        before = 0
        for d in sorted({d for k, d, _ in rows if k == c}):
            own = sum(t for k, x, t in rows if k == c and x == d)
            assert (d / 2**32 < got.get(c, 0.0)) == (before + own / 2 < quota), (c, d)
            before += own


def test_mixing_edges(spark):
    frame = docs(spark, EDGES).withColumn("lang", F.lit(None).cast("string"))
    got = registry.mixed(frame)
    assert got.count() == len(EDGES) and got.where("__probability is null or __draw is null").count() == 0
    assert registry.mixed(docs(spark, [])).count() == 0


def test_turns_without_a_conversation_stand_alone(spark):
    turns = [(None, 0, "user", "hi"), (None, 1, "user", "yo"), (None, 5, "user", "hi"), (1, 0, "user", "hi"), (1, 1, "user", "more"), (2, 0, "user", "yo"), (None, 0, "user", "alone")]
    got = sorted((str(r.conv_id), r.n_turns, r.n_copies, r.rendered.count("im_start")) for r in chat.maximal_conversations(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect())
    assert got == [("1", 2, 1, 2), ("2", 1, 2, 1), ("None", 1, 1, 1)]


def test_chat_edges(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (2, 0, "user", "hi"), (3, 0, "user", "hi"), (3, 1, "assistant", "yo"), (3, 2, "user", None), (4, 0, "user", "hi"), (4, 1, "assistant", "yo"), (4, 2, "user", ""), (None, None, None, None), (5, 0, "user", "hello"), (5, 0, "user", "hello")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("ha", F.lit(1))
    got = {r.conv_id: (r.n_turns, r.n_copies) for r in chat.maximal_conversations(df).collect()}
    assert got == {3: (3, 2), None: (1, 1), 5: (2, 1)}
    assert chat.maximal_conversations(df.limit(0)).count() == 0


def test_words_are_cut_at_the_same_bytes():
    hasher = common.WordHasher(segment=16)
    data = "ab  CD\x0b e \x1cf ".encode() * 50 + b"x" * 100
    hashes, starts = hasher.words(np.frombuffer(data, np.uint8))
    words = data.lower().split()
    assert len(hashes) == len(words)
    assert len(set(hashes.tolist())) == len(set(words)) and [hashes.tolist().index(h) for h in hashes.tolist()] == [words.index(w) for w in words]


def test_pipeline_is_its_stages(spark):
    import corpus_pipeline

    frame = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in frame.collect()}
    model = toxicity.fit(frame, spark.read.parquet(f"{SF}/labels.parquet"))
    left = {i for i, r in rows.items() if brute_score(r.text, model) < 0.7}
    limits = quality_rules.Limits()

    def good(text):
        n, _, _, _, repeated = brute_quality(text)
        return n >= 10 and 100 * repeated <= 20 * n and brute_compression(text.encode(), limits)

    left = {i for i in left if good(rows[i].text)}
    component, _ = brute_components([(i, rows[i].text) for i in left])
    left = {i for i in left if component[i] == i}
    at = {}
    out = frame
    for name, stage in corpus_pipeline.STAGES:
        out = common.materialise(stage(spark, out, SF), "test")
        at[name] = {r.doc_id for r in out.select("doc_id").collect()}
        assert name == "sentencepiece" or out.columns == corpus_pipeline.COLUMNS
    assert at["near_duplicates"] == left and at["mixing"] <= left and at["sentencepiece"] == at["mixing"]
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == at["sentencepiece"]
    kept = corpus_pipeline.STAGES[2][1](spark, docs(spark, EDGES), SF).collect()
    assert sorted(r.doc_id for r in kept) == [1, 2, 3, 4, 5, 7, 8, 9]  # the copy without doc_id goes


def test_pipeline_keeps_different_texts_of_one_id(spark):
    import corpus_pipeline

    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (1, "t u v w x y z"), (2, "h i j k l m n")]
    got = corpus_pipeline.without_near_duplicates(spark, docs(spark, rows), SF).collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted(set(rows))


def test_licences_count_repeated_rows_once(spark):
    text = "Released under some other License. Under the MIT License."
    once = licences.licence_scan(docs(spark, [(1, text)]), {"T": ["under the mit license under the mit license released"]}, 0.5).collect()
    twice = licences.licence_scan(docs(spark, [(1, text), (1, text)]), {"T": ["under the mit license under the mit license released"]}, 0.5).collect()
    assert [(r.unit, r.position, round(r.dice, 6)) for r in sorted(once)] == [("line", 0, 0.5), ("passage", 4, 0.666667)] and sorted(once) == sorted(twice)


def test_pipeline_does_not_mix_by_the_first_word(spark):
    import corpus_pipeline

    rows = [(k, f"{'the' if k % 3 else f'w{k}'} word and more") for k in range(90)]
    assert corpus_pipeline.to_target_weights(spark, docs(spark, rows), SF).count() == 90


def test_pipeline_groups_texts_without_doc_id(spark):
    import corpus_pipeline

    text = "a b c d e f g h i j k l m n"
    frame = docs(spark, [(None, text), (None, text), (None, "other words in here"), (4, text + " o")])
    got = corpus_pipeline.without_near_duplicates(spark, frame, SF).collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == [("4", text + " o"), ("None", "other words in here")]


@pytest.mark.parametrize("name,stage", [(n, k) for k, n in enumerate(("toxicity", "quality", "near_duplicates", "mixing", "sentencepiece"))])
def test_pipeline_stages_on_edges(spark, name, stage):
    import corpus_pipeline

    run = corpus_pipeline.STAGES[stage][1]
    assert run(spark, docs(spark, []), SF).count() == 0
    got = run(spark, docs(spark, EDGES).withColumn("lang", F.lit(None).cast("string")), SF).collect()
    assert len(got) == {"toxicity": 10, "quality": 0, "near_duplicates": 8, "mixing": len(got), "sentencepiece": 10}[name]


def test_shared_folder_is_asked_for(spark):
    class Conf:
        get = staticmethod(lambda *a: None)

    class Context:
        master, getConf, getCheckpointDir = "spark://far:7077", staticmethod(lambda: Conf), staticmethod(lambda: None)

    class Session:
        sparkContext, conf = Context, Conf

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        common.shared_root(Session)
