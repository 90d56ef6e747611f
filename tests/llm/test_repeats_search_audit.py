"""Substring dedup, ranked search and the filter audit against brute force, with their defined edge cases."""

import hashlib
import itertools
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldloom.llm import filter_audit, ranked_search, repeats

DOCS = "doc_id long, text string, lang string, part string, spans string, key long, score long, n long"
LABELS = "doc_id long, quality int, toxic int, mask int, n int"


def docs(spark, rows):
    """(doc_id, text[, lang]) with extra columns whose names clash with internal ones."""
    return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else "en", "p", "s", 1, 2, 3) for r in rows], DOCS)


EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (7, "é" * 30), (8, "word " * 20000), (9, "x" * 60000), (10, "word " * 20000)]


def without_repeats_by_brute_force(rows, window=50):
    """(doc_id, n_words, n_removed, kept) of each row, by the definition."""
    worded = [(i, (t or "").encode().split()) for i, t, *_ in rows]
    first = {}
    for i, w in worded:
        for k in range(len(w) - window + 1):
            if i is not None:
                h = tuple(w[k : k + window])
                first[h] = min(first.get(h, i), i)
    out = []
    for i, w in worded:
        gone = np.zeros(len(w), bool)
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < i:
                gone[k : k + window] = True
        out.append((i, len(w), int(gone.sum()), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out, key=repr)


def got_without(spark, rows, params=repeats.Params()):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in repeats.without_repeats(docs(spark, rows), params).collect()), key=repr)


@pytest.mark.parametrize("params", [repeats.Params(), repeats.Params(chunk_bytes=4000, part_bytes=20_000, most_sent=0)])
def test_repeats_equal_brute_force(spark, params):
    """Passages of 48 to 120 words in many texts, cut, joined and moved; copies; near copies; repeats within one text; one doc_id with two texts."""
    rng = np.random.default_rng(8)
    word = lambda: f"w{rng.integers(3000)}"
    passages = [[word() for _ in range(int(n))] for n in (48, 49, 50, 51, 60, 75, 99, 120)]
    rows = []
    for i in rng.permutation(140):
        text = [word() for _ in range(int(rng.integers(0, 30)))]
        for _ in range(int(rng.integers(0, 4))):
            p = passages[int(rng.integers(len(passages)))]
            a = int(rng.integers(0, 12)) if rng.random() < 0.4 else 0
            text += p[a : len(p) - (int(rng.integers(0, 12)) if rng.random() < 0.4 else 0)] + [word() for _ in range(int(rng.integers(0, 3)))]
        rows.append((int(i), " ".join(text)))
    rows += [(500 + k, rows[k][1].replace(" ", "  \n")) for k in range(12)]
    rows += [(600 + k, " ".join(x if rng.random() > 0.01 else word() for x in rows[k][1].split())) for k in range(12)]
    rows += [(700, " ".join(passages[6] * 3)), (-5, " ".join(passages[4] * 2)), (701, " ".join(passages[5])), (701, " ".join(passages[3]) + " tail"), (702, " ".join(passages[7]).upper())]
    rows += [rows[0], rows[0], (None, rows[1][1])]
    want = without_repeats_by_brute_force(rows)
    assert sum(r[2] > 0 for r in want) > 60
    assert got_without(spark, rows, params) == want


def test_repeats_edges(spark):
    """Null, empty and blank texts, short ones, repeated rows, null ids, one long word, a text that repeats itself, a copy of it; an empty table."""
    assert got_without(spark, EDGES) == without_repeats_by_brute_force(EDGES)
    assert got_without(spark, []) == []
    found = repeats.repeats(docs(spark, EDGES)).collect()
    assert [(r.doc_id, r.spans, r.whole) for r in found] == [(10, None, True)]


def test_repeats_name_their_spans(spark):
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(3, "a " + passage + " b"), (1, "c d " + passage), (2, passage + " " + passage.upper() + " " + passage)]
    found = {r.doc_id: [tuple(s) for s in r.spans] for r in repeats.repeats(docs(spark, rows)).collect()}
    assert found == {3: [(1, 61, 1)], 2: [(0, 60, 1), (120, 180, 1)]}


TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def ranked_by_brute_force(rows, items, k=10):
    worded = [(i, terms(t)) for i, t, *_ in rows]
    documents, total = sum(bool(w) for _, w in worded), sum(len(w) for _, w in worded)
    df = Counter(t for _, w in worded for t in set(w))
    out = []
    for item, text in items:
        scores = []
        for i, w in worded:
            tf, score = Counter(w), 0
            m = 25 + 75 * len(w) * documents // total if total else 0
            for t in terms(text):
                if tf[t]:
                    score += math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 8 * m))
            if score > 0:
                scores.append((-score, i is None, i))
        out += [(item, n + 1, i, -s) for n, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=repr)


def got_ranked(spark, rows, items, params=ranked_search.Params()):
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, score int")
    found = ranked_search.ranked(docs(spark, rows), asked, params)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect()), key=repr)


@pytest.mark.parametrize("params", [ranked_search.Params(), ranked_search.Params(block_terms=30, cells=300, shard_bytes=2000), ranked_search.Params(k=3, cells=1)])
def test_ranked_search_equals_brute_force(spark, params):
    """Common and rare terms, ties, repeated terms in items and texts, terms beyond ASCII, items without any known term."""
    rng = np.random.default_rng(5)
    draw = lambda n: [f"T{min(int(x), 400)}" for x in rng.zipf(1.4, n)]
    rows = [(int(i), ", ".join(draw(int(rng.integers(0, 60)))) + (" Été_straße" if i % 7 == 0 else "")) for i in rng.permutation(300)]
    rows += [(1000 + k, rows[3][1]) for k in range(15)] + [rows[5], rows[5], (None, rows[3][1])]
    items = [(k, " ".join(draw(int(rng.integers(1, 25))))) for k in range(20)] + [(20, "été STRASSE straße"), (21, "nothing-known"), (22, None), (23, ""), (24, rows[3][1]), (25, "t1 t1 t1")]
    assert got_ranked(spark, rows, items, params) == ranked_by_brute_force(rows, items, params.k)


def test_ranked_search_edges(spark):
    """Null, empty and blank texts, repeated rows, null ids, very long texts; empty tables."""
    items = [(1, "a word"), (2, "é" * 30), (2, "b")]
    want = ranked_by_brute_force(EDGES, items)
    assert got_ranked(spark, EDGES, items) == want
    assert got_ranked(spark, [], items) == [] and got_ranked(spark, EDGES, []) == []
    assert got_ranked(spark, [(1, None), (2, "")], items) == []


def test_threshold_search_stops_early():
    """One document far ahead of all others: the lists are not read to their end, and the result is that of all documents."""
    import pyarrow as pa

    n, width = 2000, 3
    doc, term = np.repeat(np.arange(n), width), np.tile(np.arange(width), n)
    tf = np.ones(n * width, np.int64)
    tf[:30] = 50
    index = ranked_search._Index(pa.array(range(n)), np.full(n, 100), doc, term, tf, width, (n, 100 * n))
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    scores, ids = ranked_search.threshold_search(index, np.arange(width), np.array([5, 3, 2]), 10, none)
    assert ids.tolist() == list(range(10)) and index.seen.sum() < 100
    # The eleventh ties with all others: they are all looked at, so that the smallest id wins.
    scores, ids = ranked_search.threshold_search(index, np.arange(width), np.array([5, 3, 2]), 11, none)
    assert ids.tolist() == list(range(11)) and index.seen.all()


def audit_by_brute_force(rows, labels):
    """Every count of every order, by the definition."""
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    marks = defaultdict(lambda: [0, 0])
    for i, q, x in labels:
        if i is not None:
            marks[i] = [max(marks[i][0], q == 1), max(marks[i][1], x == 1)]
    parts = defaultdict(list)
    for i, t, lang in rows:
        t = t or ""
        w = t.encode().split()
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > first[t]}
        parts[lang or ""].append(({f for f, bad in fails.items() if bad}, *(marks[i] if i is not None else [0, 0])))
    out = []
    for part, own in parts.items():
        shapley, steps = Counter(), []
        for order in itertools.permutations("ABCDE"):
            left = own
            for s, f in enumerate(order):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                shapley[f] += len(gone)
                failing = sum(f in r[0] for r in own)
                steps.append((part, "".join(order), s + 1, len(left), len(gone), failing - len(gone), sum(r[0] == {f} for r in own), sum(r[1] for r in gone), sum(r[2] for r in gone), f))
        out += [(*s[:-1], shapley[s[-1]]) for s in steps]
    return sorted(out)


def got_audit(spark, rows, labels):
    out = filter_audit.audit(docs(spark, rows), spark.createDataFrame([(*x, 1, 1) for x in labels], LABELS))
    assert out.columns == filter_audit.COLUMNS
    return sorted(tuple(r) for r in out.collect())


def test_audit_equals_brute_force(spark):
    """All masks occur; copies over parts; labels of several kinds, doubled, null and without a document."""
    rng = np.random.default_rng(6)
    rows = []
    for i in range(160):
        n = int(rng.choice([0, 50, 199, 200, 260]))
        words = [f"x{k}" if rng.random() < 0.6 else f"x{k % 9}" for k in range(n)] if i % 2 else [f"x{k % max(1, n // 3)}" for k in range(n)]
        text = " ".join(w.upper() if i % 3 == 0 else w for w in words) + ("#" if i % 5 == 0 else "") + ("é" if i % 7 == 0 else "")
        rows.append((i, text, ["en", "de", None][i % 3]))
    rows += [(200 + k, rows[k * 3][1], "fr") for k in range(30)] + [rows[4], (None, rows[5][1], "en"), (-1, None, "en")]
    labels = [(i, int(i % 2), int(i % 5 == 0)) for i in range(0, 230, 3)] + [(3, 1, 1), (3, None, None), (None, 1, 1), (9999, 1, 1), (6, 0, 1)]
    assert got_audit(spark, rows, labels) == audit_by_brute_force(rows, labels)


def test_audit_edges(spark):
    rows = [(i, t, "en") for i, t in EDGES]
    assert got_audit(spark, rows, []) == audit_by_brute_force(rows, [])
    assert got_audit(spark, [], [(1, 1, 1)]) == []


def test_limits_of_filters_are_exact(spark):
    """199 and 200 words, half of them distinct and one less, 3 of 100 code points upper and one more."""
    words = lambda n, distinct: " ".join(f"w{k % distinct}" for k in range(n))
    texts = [words(199, 199), words(200, 200), words(200, 100), words(200, 99), "ABC" + "é" * 97, "ABCD" + "é" * 96]
    got = {r.doc_id: r["mask"] for r in filter_audit.failures(docs(spark, list(enumerate(texts)))).collect()}
    assert got == {0: 1, 1: 0, 2: 0, 3: 2, 4: 1, 5: 5}


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_swaps_visit_every_order_once(n):
    seen, before = [], None
    for order, place in filter_audit.swaps(n):
        if before is not None:
            swapped = list(before)
            swapped[place], swapped[place + 1] = swapped[place + 1], swapped[place]
            assert tuple(swapped) == order
        seen.append(order)
        before = order
    assert len(set(seen)) == len(seen) == math.factorial(n)


def test_kept_words_are_hashed_as_utf8(spark):
    out = repeats.without_repeats(docs(spark, [(1, " Größe\tund  Maß ")])).select(F.sha2("kept", 256).alias("h")).first().h
    assert out == hashlib.sha256("Größe und Maß".encode()).hexdigest()
