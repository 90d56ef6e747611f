"""Near duplicates by circulant MinHash: one permutation spreads the shingles, circular shifts of another give every coordinate."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHasher, grouped_words, materialise, mixed_bits, released, rows_within, shingle_set, text_groups
from .components import connected_components


#: Exclusive-or with one of these orders the documents of a bucket anew, for a second pivot.
_SALTS = (0x2545F4914F6CDD1D, 0x1D8E4E27C47D124F, 0x5DEECE66D1234567)


@dataclass(frozen=True)
class Params:
    """Two texts are linked if `percent` of the union of their shingles is shared.

    `bands` bands of `rows` coordinates out of `coordinates`: a pair at the limit of 0.75 misses every band with a chance
    of 2e-5. All coordinates make a sketch of two bits each; pairs whose sketches differ in over `most_differing` coordinates
    are left out before the full comparison (a pair at the limit: 4e-6).
    """

    shingle: int = 5
    percent: int = 75
    bands: int = 56
    rows: int = 6
    coordinates: int = 1024
    universe: int = 1 << 18
    seed: int = 11

    @property
    def most_differing(self) -> int:
        p = (1 - self.percent / 100) * 3 / 4  # two random values agree in both bits once in four times
        return int(self.coordinates * p + 4.5 * (self.coordinates * p * (1 - p)) ** 0.5)

    @property
    def sketch(self) -> list[str]:
        """Columns of the first bits, then those of the second."""
        return [f"{plane}{k}" for plane in "st" for k in range(self.coordinates // 64)]


def _permutations(universe: int, coordinates: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The first permutation, and every circular shift of the second: row p holds its values from position p on."""
    rng = np.random.default_rng(seed)
    spread, shifted = rng.permutation(universe).astype(np.uint32), rng.permutation(universe).astype(np.uint32)
    return spread, np.lib.stride_tricks.sliding_window_view(np.concatenate([shifted, shifted[:coordinates]]), coordinates)


def signature(shingles: np.ndarray, p: Params, permutations: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """All coordinates: the least value over the shingles' rows of the shifted permutation."""
    spread, shifts = permutations
    at = spread[(shingles >> np.uint64(40)).astype(np.int64) % p.universe]
    out = np.full(p.coordinates, p.universe, np.uint32)
    for k in range(0, len(at), 128):
        np.minimum(out, np.minimum.reduce(shifts[at[k : k + 128]], axis=0), out=out)
    return out


def _band_hashes(signatures: np.ndarray, p: Params) -> np.ndarray:
    """(texts, bands) of int64."""
    parts = signatures[:, : p.bands * p.rows].astype(np.uint64).reshape(len(signatures), p.bands, p.rows)
    out = np.broadcast_to(np.arange(1, p.bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(p.rows):
        out = mixed_bits(out * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return out.view(np.int64)


def _sketches(signatures: np.ndarray) -> np.ndarray:
    """(texts, coordinates / 32) of int64: a plane of one bit of each coordinate, and one of another."""
    mixed = mixed_bits(signatures.astype(np.uint64) + np.uint64(1))
    planes = [np.packbits(((mixed >> np.uint64(k)) & np.uint64(1)).astype(np.uint8), axis=1).view(np.int64) for k in (0, 1)]
    return np.concatenate(planes, axis=1)


def _sign(p: Params):
    def run(batches):
        hasher, permutations = WordHasher(), _permutations(p.universe, p.coordinates, p.seed)
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for first, parts in text_groups(texts):
                n, key, rows = [], [], []
                for words in grouped_words(hasher, parts):
                    shingles = shingle_set(words, p.shingle)
                    n.append(len(shingles))
                    if len(words):
                        digest = xxhash.xxh3_128_digest(words.tobytes())
                        key.append((int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)))
                        rows.append(signature(shingles, p, permutations))
                    else:
                        key.append((None, None))
                        rows.append(np.zeros(p.coordinates, np.uint32))
                signatures = np.stack(rows)
                bands = _band_hashes(signatures, p)
                sketch = _sketches(signatures)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(parts)),
                        pa.array(n, pa.int64()),
                        pa.array([k[0] for k in key], pa.int64()),
                        pa.array([k[1] for k in key], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(parts) + 1) * p.bands, pa.int32()), pa.array(bands.ravel())),
                        *(pa.array(np.ascontiguousarray(sketch[:, k])) for k in range(sketch.shape[1])),
                    ],
                    names=["doc_id", "n_shingles", "k1", "k2", "bands", *p.sketch],
                )

    return run


def _sets(p: Params):
    def run(batches):
        hasher = WordHasher()
        for batch in batches:
            for first, parts in text_groups(batch.column(1).cast(pa.binary())):
                sets = [shingle_set(w, p.shingle).view(np.int64) for w in grouped_words(hasher, parts)]
                ends = np.cumsum([0, *map(len, sets)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(parts)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets)))],
                    names=["doc_id", "shingles"],
                )

    return run


def _alike(p: Params, a: str, b: str):
    """Sizes and sketches leave the pair possible."""
    half = len(p.sketch) // 2
    apart = lambda c: F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))
    differing = reduce(lambda x, y: x + y, (F.bit_count(apart(x).bitwiseOR(apart(y))) for x, y in zip(p.sketch[:half], p.sketch[half:])))
    na, nb = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    return (100 * F.least(na, nb) >= p.percent * F.greatest(na, nb)) & (differing <= p.most_differing)


def _confirmed(documents: DataFrame, pairs: DataFrame, p: Params) -> DataFrame:
    """The pairs (u, v) linked by their full shingle sets."""
    pairs = materialise(pairs, "pairs")
    ids = pairs.select(F.col("u").alias("id")).union(pairs.select("v")).distinct()
    texts = rows_within(documents, "doc_id", materialise(ids, "ids"), "id")
    sets = materialise(texts.mapInArrow(released(_sets(p)), "doc_id long, shingles array<long>"), "sets")
    left = pairs.join(sets.select(F.col("doc_id").alias("u"), F.col("shingles").alias("su")), "u")
    both = left.join(sets.select(F.col("doc_id").alias("v"), F.col("shingles").alias("sv")), "v")
    shared = F.size(F.array_intersect("su", "sv")).cast("long")
    return both.where(100 * shared >= p.percent * (F.size("su") + F.size("sv") - shared)).select("u", "v").distinct()


def near_duplicates(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, copy_of) for each row of `docs` (doc_id, text; other columns are ignored).

    Texts are lower-cased in A-Z and cut into words at ASCII white space. Links hold between texts with
    100 * intersection >= percent * union of their shingle sets. component_id is the smallest doc_id that links
    reach; kept marks that document; copy_of is the smallest doc_id with the same word sequence. Null, empty and
    blank texts have no shingles and no link. Every row is returned, repeated ones too; texts whose smallest doc_id is
    the same are one node. A null doc_id stays alone (component null, kept). An empty table gives an empty result.

    Equal word sequences are folded first, so that a group of copies costs one signature in the bands. In each bucket,
    members are compared with at most two pivots (smallest id, first id in another order); only members that are still in
    different components meet in pairs, those whose sizes and sketches allow a link. Every such link is confirmed on
    the full sets, so that no bucket has a cap.
    """
    p = params
    documents = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>, " + ", ".join(f"{s} long" for s in p.sketch)
    signed = materialise(documents.mapInArrow(released(_sign(p)), schema), "signed")

    worded = signed.where("k1 is not null and doc_id is not null")
    copies = materialise(worded.groupBy("k1", "k2").agg(F.min("doc_id").alias("copy_of")), "copies")
    # Repeated rows fold where they are read, and of a group of copies only the first meets the join, so that no key gathers a group.
    firsts = copies.select("k1", "k2", F.col("copy_of").alias("doc_id"))
    wide = worded.select("k1", "k2", "doc_id", "bands").dropDuplicates(["k1", "k2", "doc_id"]).join(firsts, ["k1", "k2", "doc_id"], "left_semi")

    banded = materialise(wide.select("doc_id", "bands"), "distinct").select(F.col("doc_id").alias("rep"), F.posexplode("bands").alias("band", "h"))
    # A bucket's pivots are partial minima that are joined back, so that the members of a full bucket may be split over tasks.
    salt = F.element_at(F.array(*(F.lit(m) for m in _SALTS)), (F.pmod("h", F.lit(len(_SALTS))) + 1).cast("int"))
    buckets = banded.groupBy("h").agg(F.min("rep").alias("first"), F.max("rep").alias("last"), F.min(F.col("rep").bitwiseXOR(salt)).alias("salted")).where("first <> last")
    met = banded.join(buckets.select("h", "first", F.col("salted").bitwiseXOR(salt).alias("other")), "h")
    met = materialise(met.select("h", "band", "rep", "first", "other"), "buckets")
    reps = signed.where("k1 is not null").select(F.col("doc_id").alias("rep"), "n_shingles", "bands", *p.sketch)
    features = materialise(reps.join(met.select("rep").distinct(), "rep", "left_semi").distinct(), "features")

    def pair(a: str, b: str) -> DataFrame:
        return met.where(f"{a} <> {b}").select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v"))

    stars = pair("rep", "first").union(pair("rep", "other")).distinct()
    stars = stars.alias("e").join(features.alias("a"), F.col("e.u") == F.col("a.rep")).join(features.alias("b"), F.col("e.v") == F.col("b.rep")).where(_alike(p, "a", "b")).select("u", "v")
    near = _confirmed(documents, stars, p)
    labels = materialise(connected_components(near), "labels")

    # Members of a bucket that are not yet in one component. A pair comes from the first band that it shares, and from that one only.
    tagged = met.select("h", "band", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("h", "band", "rep", F.coalesce("component", "rep").alias("part"))
    tagged = materialise(tagged, "tagged")
    open_ = tagged.groupBy("h").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo <> hi").select("h")
    full = materialise(tagged.join(open_, "h", "left_semi").join(features, "rep"), "apart")
    first_shared = F.array_position(F.zip_with("a.bands", "b.bands", lambda x, y: x == y), F.lit(True)) == F.col("a.band") + 1
    rest = full.alias("a").join(full.alias("b"), (F.col("a.h") == F.col("b.h")) & (F.col("a.rep") < F.col("b.rep")) & (F.col("a.part") != F.col("b.part")) & _alike(p, "a", "b") & first_shared)
    rest = rest.select(F.col("a.rep").alias("u"), F.col("b.rep").alias("v")).distinct()
    more = _confirmed(documents, rest, p)
    linked = connected_components(labels.select(F.col("node").alias("u"), F.col("component").alias("v")).union(more))

    members = signed.select("doc_id", "n_shingles", "k1", "k2").join(copies, ["k1", "k2"], "left")
    members = members.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("copy_of", "doc_id")).alias("copy_of"))
    return members.join(linked.withColumnRenamed("node", "copy_of"), "copy_of", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component", "copy_of").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.coalesce("component", "copy_of")).alias("kept"),
        "copy_of",
    )
