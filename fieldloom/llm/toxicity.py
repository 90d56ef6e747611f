"""Toxicity by non-negative positive-unlabelled learning over the presence of selected words and word beginnings."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WordHasher, materialise, released, text_groups


@dataclass(frozen=True)
class Params:
    """Bounds of the fit. At most `most_positive` confirmed toxic and `most_unlabelled` other texts are taken, those of the smallest hash
    of doc_id, each text once, and at most `most_words` features from them: those of at least `least_texts` toxic texts, `least_lift`
    times as common there as among the unlabelled texts, with shares `least_z` standard errors apart, the furthest first. `prior`: share of toxic texts; None: as among the labels.
    """

    most_positive: int = 4000
    most_unlabelled: int = 12000
    most_words: int = 2000
    least_texts: int = 5
    least_lift: float = 3.0
    least_z: float = 5.0
    prior: float | None = None
    steps: int = 600
    rate: float = 0.1
    decay: float = 1e-5
    threshold: float = 0.7


#: Lengths in bytes of the word beginnings that are features beside whole words; stems are shared by many words.
BEGINNINGS = (4, 5, 6, 7)


def features(text: bytes) -> set[bytes]:
    """Whole words, lower-cased in A-Z and marked by a space behind, and the beginnings of longer ones."""
    words = set(text.lower().split())
    out = {w + b" " for w in words}
    for n in BEGINNINGS:
        out.update([w[:n] for w in words if len(w) >= n])
    return out


@dataclass(frozen=True)
class Model:
    """Features with their weights. A score is the logistic function of the bias and the weights of the features that a text holds, each once."""

    numbers: dict[bytes, int]
    weights: np.ndarray
    bias: float

    def scorer(self):
        """A function from many texts to their scores. Words are looked up by 64-bit hashes, and of those only with a hash whose top bits some feature shares."""
        hasher = WordHasher()
        one = lambda word: hasher.words(np.frombuffer(word, np.uint8))[0][0]
        keys = np.array([one(w[:-1]) if w.endswith(b" ") else one(w) ^ _BEGINNING for w in self.numbers], np.uint64)
        order = np.argsort(keys)
        keys, places = keys[order], np.fromiter(self.numbers.values(), np.int64)[order]
        near = np.zeros(1 << 16, bool)
        near[(keys >> np.uint64(48)).astype(np.int64)] = True
        width = max(1, len(self.weights))

        def score(texts: list[bytes]) -> np.ndarray:
            ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
            found = [np.zeros(0, np.int64)]
            for whole, hashes, starts in hasher.words_and_beginnings(np.frombuffer(b"\n".join(texts), np.uint8), BEGINNINGS) if len(keys) else ():
                hashes = hashes if whole else hashes ^ _BEGINNING
                likely = np.flatnonzero(near[(hashes >> np.uint64(48)).astype(np.int64)])
                at = np.minimum(np.searchsorted(keys, hashes[likely]), len(keys) - 1)
                hit = keys[at] == hashes[likely]
                found.append(np.searchsorted(ends, starts[likely[hit]], side="right") * width + places[at[hit]])
            once = np.unique(np.concatenate(found))
            sums = self.bias + np.bincount(once // width, self.weights[once % width] if len(self.weights) else None, len(texts))
            return 1 / (1 + np.exp(-np.clip(sums, -30, 30)))

        return score


#: Parts the hashes of beginnings from those of whole words.
_BEGINNING = np.uint64(0x5851F42D4C957F2D)


def fold_of(doc_id: str = "doc_id"):
    """crc32 of the id as text, mod 3; 1 is held out."""
    return F.crc32(F.col(doc_id).cast("string")) % 3


class Presence:
    """Rows of word numbers, kept as one flat array with offsets."""

    def __init__(self, rows: list[list[int]], width: int):
        self.flat = np.fromiter((w for r in rows for w in r), np.int64)
        self.ends = np.cumsum([0, *map(len, rows)])
        self.row = np.repeat(np.arange(len(rows)), np.diff(self.ends))
        self.width = width

    def margin(self, weights: np.ndarray, bias: float) -> np.ndarray:
        return bias + np.bincount(self.row, weights[self.flat], len(self.ends) - 1)

    def pull(self, by_row: np.ndarray) -> np.ndarray:
        return np.bincount(self.flat, by_row[self.row], self.width)


def fit_nnpu(positive: Presence, unlabelled: Presence, prior: float, p: Params) -> tuple[np.ndarray, float]:
    """Adam on the non-negative risk: prior * E_pos[loss(+)] + max(0, E_unl[loss(-)] - prior * E_pos[loss(-)]), logistic loss.

    While the bracket is below zero, the step goes against its gradient, which undoes the overfit to the unlabelled texts.
    """
    width = positive.width
    theta, m, v = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    theta[width] = np.log(prior / (1 - prior))
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -30, 30)))
    for step in range(1, p.steps + 1):
        fp, fu = positive.margin(theta[:width], theta[width]), unlabelled.margin(theta[:width], theta[width])
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        up, down_p, down_u = (sigmoid(fp) - 1) / len(fp), sigmoid(fp) / len(fp), sigmoid(fu) / len(fu)
        if negative >= 0:
            on_p, on_u = prior * up - prior * down_p, down_u
        else:
            on_p, on_u = prior * down_p, -down_u
        gradient = np.concatenate([positive.pull(on_p) + unlabelled.pull(on_u) + p.decay * theta[:width], [on_p.sum() + on_u.sum()]])
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        theta -= p.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return theta[:width], float(theta[width])


def fit(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> Model:
    """A model from confirmed toxic texts and unlabelled ones, both outside the held-out fold.

    Only the ids of the sample, the chosen words and the sample's word numbers reach the driver, all of bounded size. Without a
    toxic label outside the fold, the model scores every text 0 or nearly so.
    """
    p = params
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic")).where(fold_of() != 1)
    prior = p.prior or known.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
    if prior <= 0:
        return Model({}, np.zeros(0), -30.0)
    prior = min(prior, 0.5)
    chosen = F.xxhash64("doc_id")
    positive = known.where("toxic = 1").orderBy(chosen, "doc_id").limit(p.most_positive).select("doc_id", F.lit(1).alias("pos"))
    other = docs.where("doc_id is not null").where(fold_of() != 1).select("doc_id").orderBy(chosen, "doc_id").limit(p.most_unlabelled).select("doc_id", F.lit(0).alias("pos"))
    sample = materialise(positive.union(other), "sample")  # at most most_positive + most_unlabelled ids

    def read(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                found = [sorted(features(t.as_py() or b"")) for t in part.column(1).cast(pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(pa.binary()))], names=["pos", "found"])

    texts = materialise(docs.join(F.broadcast(sample), "doc_id").select("pos", "text").distinct().mapInArrow(released(read), "pos int, found array<binary>"), "sampled_texts")
    totals = dict(texts.groupBy("pos").count().collect())
    if not totals.get(1) or not totals.get(0):
        return Model({}, np.zeros(0), -30.0)
    counts = texts.select("pos", F.explode("found").alias("w")).groupBy("w").agg(F.sum("pos").alias("p"), F.sum(1 - F.col("pos")).alias("u"))
    here, there = F.col("p") / totals[1], F.col("u") / totals[0]
    z = (here - there) / F.sqrt((F.col("p") + F.col("u")) / (totals[0] + totals[1]) * (1 / totals[0] + 1 / totals[1]))
    known_words = counts.where((F.col("p") >= p.least_texts) & (here >= p.least_lift * there) & (z >= p.least_z)).orderBy(z.desc(), "w").limit(p.most_words).select("w")
    numbers = {bytes(r["w"]): k for k, r in enumerate(known_words.collect())}

    def number(batches):
        for batch in batches:
            own = [[numbers[w] for w in words if w in numbers] for words in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.list_(pa.int32()))], names=["pos", "own"])

    rows = {0: [], 1: []}
    for pos, own in texts.mapInArrow(number, "pos int, own array<int>").toLocalIterator():
        rows[pos].append(own)
    weights, bias = fit_nnpu(Presence(rows[1], len(numbers)), Presence(rows[0], len(numbers)), prior, p)
    return Model(numbers, weights, bias)


def with_scores(docs: DataFrame, model: Model, name: str = "__toxicity") -> DataFrame:
    """`docs` with the score of each whole text in the double column `name`, which is replaced if there. A null or empty text gets the score of no words."""
    docs = docs.drop(name)
    at = docs.columns.index("text")
    docs = docs.withColumn("text", F.col("text").cast("string"))

    def run(batches):
        score = model.scorer()
        for batch in batches:
            scores = [score(parts) for _, parts in text_groups(batch.column(at).cast(pa.binary()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(scores) if scores else [], pa.float64())], names=[*batch.schema.names, name])

    return docs.mapInArrow(released(run), T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of `docs`; labels of held-out ids, those with crc32(id as text) mod 3 = 1, are never read by the fit.

    Repeated rows are each scored; a null doc_id is not held out and takes no part in the fit; extra columns are
    ignored; conflicting labels of an id count as toxic. An empty table gives an empty result.
    """
    model = fit(docs, labels, params)
    scored = with_scores(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    return scored.select("doc_id", F.coalesce(fold_of() == 1, F.lit(False)).alias("held_out"), F.col("__toxicity").alias("score"), (F.col("__toxicity") >= params.threshold).cast("int").alias("predicted"))
