"""Filter interaction audit: what each filter removes in every order, walked by adjacent swaps over counts of failure masks."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHasher, grouped_words, materialise, text_groups


@dataclass(frozen=True)
class Filters:
    """A: fewer than `least_words` words. B: distinct words below `least_distinct` percent of the words. C: letters A-Z above `most_upper` percent of
    the code points. D: any of `symbols`. E: a text that a smaller doc_id has too.
    """

    least_words: int = 200
    least_distinct: int = 50
    most_upper: int = 3
    symbols: bytes = b"#$%&*|"
    names: str = "ABCDE"


def _masks(p: Filters):
    """(doc_id, part, mask, digest): bit k of the mask is set where filter k fails, for the filters that one text decides."""
    is_symbol, is_upper, begins = np.zeros(256, bool), np.zeros(256, bool), np.ones(256, bool)
    is_symbol[list(p.symbols)] = True
    is_upper[65:91] = True
    begins[0x80:0xC0] = False

    def run(batches):
        hasher = WordHasher(lower=False)
        for batch in batches:
            for first, parts in text_groups(batch.column(1).cast(pa.binary())):
                masks, digests = [], []
                for part, words in zip(parts, grouped_words(hasher, parts)):
                    data, n = np.frombuffer(part, np.uint8), len(words)
                    few = n < p.least_words
                    dull = 100 * len(np.unique(words)) < p.least_distinct * n
                    loud = 100 * np.count_nonzero(is_upper[data]) > p.most_upper * np.count_nonzero(begins[data])
                    masks.append(few + 2 * dull + 4 * loud + 8 * bool(is_symbol[data].any()))
                    digests.append(hashlib.sha256(part).digest())
                own = [batch.column(k).slice(first, len(parts)) for k in (0, 2)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(masks, pa.int32()), pa.array(digests, pa.binary())], names=["doc_id", "part", "mask", "digest"])

    return run


def failures(docs: DataFrame, filters: Filters = Filters()) -> DataFrame:
    """(doc_id, part, mask) for each row of `docs` (doc_id, text, lang; other columns are ignored): bit k of `mask` is set where the k-th filter fails.

    A null text counts as empty, a null lang as the empty part. A text repeats if a smaller doc_id has the same one anywhere in the table; rows of
    one doc_id do not repeat each other, and a null doc_id neither repeats nor is repeated. Only digests are compared, so texts stay where they are.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"))
    judged = materialise(own.mapInArrow(_masks(filters), "doc_id long, part string, mask int, digest binary"), "judged")
    firsts = judged.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    firsts = materialise(firsts.select("digest", "first"), "firsts")  # written, so that the join can split the rows of a common text
    met = judged.join(firsts, "digest", "left")
    return met.select("doc_id", "part", F.when(F.col("doc_id") > F.col("first"), F.col("mask").bitwiseOR(F.lit(16))).otherwise(F.col("mask")).alias("mask"))


def swaps(n: int):
    """All orders of 0..n-1, each with the place whose content changed places with the next one; None for the first order."""
    order, leftward = list(range(n)), [True] * n
    yield tuple(order), None
    while True:
        for x in range(n - 1, -1, -1):  # the largest that can move past a smaller one
            at = order.index(x)
            to = at - 1 if leftward[x] else at + 1
            if 0 <= to < n and order[to] < x:
                break
        else:
            return
        order[at], order[to] = order[to], order[at]
        for y in range(x + 1, n):
            leftward[y] = not leftward[y]
        yield tuple(order), min(at, to)


def _walk(names: str):
    k = len(names)
    masks = np.arange(1 << k)

    def removed_by(cells: np.ndarray, f: int, earlier: int) -> np.ndarray:
        return cells[(masks >> f & 1 == 1) & (masks & earlier == 0)].sum(axis=0)

    def run(table: pa.Table) -> pa.Table:
        cells = np.zeros((1 << k, 3), np.int64)
        np.add.at(cells, table.column("mask").to_numpy(), np.stack([table.column(c).to_numpy() for c in ("n", "good", "toxic")], axis=1))
        total = int(cells[:, 0].sum())
        fails = [int(cells[masks >> f & 1 == 1, 0].sum()) for f in range(k)]
        alone = [int(cells[1 << f, 0]) for f in range(k)]
        removed, shapley, rows = np.zeros((k, 3), np.int64), np.zeros(k, np.int64), []
        for order, swapped in swaps(k):
            for s in range(k) if swapped is None else (swapped, swapped + 1):
                removed[s] = removed_by(cells, order[s], sum(1 << f for f in order[:s]))
            shapley[list(order)] += removed[:, 0]
            kept = total - np.cumsum(removed[:, 0])
            label = "".join(names[f] for f in order)
            rows += [(label, s + 1, order[s], int(kept[s]), *map(int, removed[s])) for s in range(k)]
        label, step, f, kept, gone, good, toxic = (list(c) for c in zip(*rows))
        part = table.column("part").slice(0, 1).to_pylist() * len(rows)
        redundant = [fails[x] - g for x, g in zip(f, gone)]
        columns = [part, label, pa.array(step, pa.int32()), kept, gone, redundant, [alone[x] for x in f], good, toxic, [int(shapley[x]) for x in f]]
        return pa.Table.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=COLUMNS)

    return run


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audit(docs: DataFrame, labels: DataFrame, filters: Filters = Filters()) -> DataFrame:
    """A row for each part, order of the filters and step; the step's filter is that letter of `filter_order`.

    kept: documents left after the step; removed: taken by it; redundant: failing its filter but taken earlier; unique_fails: failing its filter only;
    good_lost and toxic_lost: removed rows with a label quality = 1, toxic = 1; shapley: the filter's removed summed over all orders. Each row
    of `docs` counts; several labels of a doc_id count as one that has what any of them has; a doc_id without a label (and a null one) is neither
    good nor toxic. `labels` needs doc_id, quality, toxic. An empty table has no part and gives no row.

    Rows are counted by part and mask (at most 2^filters cells of a part) before a part meets in one task; orders are visited by swaps of neighbours, so
    only the two steps that changed are summed anew.
    """
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("of")).agg(F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    failed = failures(docs, filters)
    met = failed.join(marks, F.col("doc_id") == F.col("of"), "left")
    cells = met.groupBy("part", "mask").agg(F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))
    kinds = dict.fromkeys(COLUMNS, "long") | {"part": "string", "filter_order": "string", "step": "int"}
    return cells.groupBy("part").applyInArrow(_walk(filters.names), ", ".join(f"{c} {t}" for c, t in kinds.items()))


def _audit_sql(p: Filters = Filters()) -> str:
    words = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"
    return f"""
WITH worded AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, {words} AS w FROM documents),
firsts AS (SELECT text, min(doc_id) AS first FROM worded GROUP BY text),
failed AS (
  SELECT doc_id, part, len(w) < {p.least_words} AS a, 100 * len(list_distinct(w)) < {p.least_distinct} * len(w) AS b,
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {p.most_upper} * length(text) AS c, regexp_matches(text, '[{p.symbols.decode()}]') AS d, coalesce(doc_id > first, false) AS e
  FROM worded JOIN firsts USING (text)),
marks AS (SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels GROUP BY doc_id),
cells AS (
  SELECT part, list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: (x = 'A' AND a) OR (x = 'B' AND b) OR (x = 'C' AND c) OR (x = 'D' AND d) OR (x = 'E' AND e)) AS fails,
         count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM failed LEFT JOIN marks USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders),
counted AS (
  SELECT part, filter_order, step, substr(filter_order, step, 1) AS f,
         sum(CASE WHEN NOT list_has_any(fails, string_split(substr(filter_order, 1, step), '')) THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN list_contains(fails, substr(filter_order, step, 1)) AND NOT list_has_any(fails, string_split(substr(filter_order, 1, step - 1), '')) THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN list_contains(fails, substr(filter_order, step, 1)) THEN n ELSE 0 END) AS failing,
         sum(CASE WHEN fails = [substr(filter_order, step, 1)] THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN list_contains(fails, substr(filter_order, step, 1)) AND NOT list_has_any(fails, string_split(substr(filter_order, 1, step - 1), '')) THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN list_contains(fails, substr(filter_order, step, 1)) AND NOT list_has_any(fails, string_split(substr(filter_order, 1, step - 1), '')) THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(failing - removed AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted
"""


AUDIT_SQL = _audit_sql()
