"""Approximate nearest neighbours: a robust-pruned directed graph in each shard, searched with a beam."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import materialise


@dataclass(frozen=True)
class Params:
    """`shard_rows`: distinct vectors of a shard, at most about; `most_pivots`: regions that the vectors are cut into, at most about;
    `probes`: regions that a query visits, the nearest by their pivots, or all if None; `degree`, `beam`, `alpha`: bounds of the graph and its pruning;
    `query_beam`: width of the search; `batch`: points inserted or queries searched together; `query_block`: queries
    that a task takes at once."""

    k: int = 10
    shard_rows: int = 4000
    most_pivots: int = 16_384
    probes: int | None = None
    degree: int = 32
    beam: int = 48
    alpha: float = 1.2
    query_beam: int = 64
    batch: int = 512
    query_block: int = 20_000
    seed: int = 5


class Points:
    """Vectors of a shard in single precision about their mean, for comparing distances; exact distances are taken elsewhere."""

    def __init__(self, vectors: np.ndarray):
        self.middle = vectors.mean(axis=0)
        self.scale = max(1.0, float(np.abs(vectors).max()) / 1e15)  # squares stay within single precision
        self.at = self.placed(vectors)
        self.norms = np.einsum("nd,nd->n", self.at, self.at)

    def placed(self, vectors: np.ndarray) -> np.ndarray:
        return ((vectors - self.middle) / self.scale).astype(np.float32)

    def apart(self, queries: np.ndarray, rows: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Squared distances of queries[rows] to the points of these numbers."""
        own = np.einsum("qd,qd->q", queries, queries)
        return np.maximum(self.norms[numbers] + own[rows] - 2 * np.einsum("nd,nd->n", self.at[numbers], queries[rows]), 0)


def _once(numbers: np.ndarray) -> np.ndarray:
    """-1 in place of a row's repeated numbers."""
    order = np.argsort(numbers, axis=1, kind="stable")
    ranked = np.take_along_axis(numbers, order, 1)
    again = np.zeros_like(ranked, bool)
    again[:, 1:] = ranked[:, 1:] == ranked[:, :-1]
    out = numbers.copy()
    np.put_along_axis(out, order, np.where(again, -1, ranked), 1)
    return out


def beam_search(queries: np.ndarray, points: Points, links: np.ndarray, entry: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The `width` best points that greedy searches from `entry` meet, nearest first (-1 where fewer), and their squared distances.

    All queries advance together; in each step a query expands its nearest unexpanded point, until all points of its beam are
    expanded. A point's distance is taken once for each query that meets it.
    """
    many = len(queries)
    beam = np.full((many, width), -1, np.int64)
    near = np.full((many, width), np.inf, np.float32)
    done = np.zeros((many, width), bool)
    met = np.zeros((many, len(points.at)), bool)
    beam[:, 0], near[:, 0], met[:, entry] = entry, points.apart(queries, np.arange(many), np.full(many, entry)), True
    active = np.arange(many)
    while len(active):
        waiting = np.where(done[active], np.inf, near[active])
        pick = waiting.argmin(axis=1)
        going = np.isfinite(waiting[np.arange(len(active)), pick])
        active, pick = active[going], pick[going]
        if not len(active):
            break
        done[active, pick] = True
        around = links[beam[active, pick]]
        fresh = (around >= 0) & ~met[active[:, None], around]
        rows, columns = np.nonzero(fresh)
        numbers = around[rows, columns]
        met[active[rows], numbers] = True
        far = np.full(around.shape, np.inf, np.float32)
        far[rows, columns] = points.apart(queries, active[rows], numbers)
        gets = np.flatnonzero((far < near[active, -1][:, None]).any(axis=1))  # other beams stay as they are
        if not len(gets):
            continue
        own = active[gets]
        both = np.concatenate([near[own], far[gets]], axis=1)
        order = np.argpartition(both, width - 1, axis=1)[:, :width]
        order = np.take_along_axis(order, np.argsort(np.take_along_axis(both, order, 1), axis=1, kind="stable"), 1)
        near[own] = np.take_along_axis(both, order, 1)
        beam[own] = np.take_along_axis(np.concatenate([beam[own], around[gets]], axis=1), order, 1)
        done[own] = np.take_along_axis(np.concatenate([done[own], np.zeros((len(own), around.shape[1]), bool)], axis=1), order, 1)
        beam[own] = np.where(np.isfinite(near[own]), beam[own], -1)
    return beam, near


def robust_prune(nodes: np.ndarray, candidates: np.ndarray, points: Points, alpha: float, degree: int) -> np.ndarray:
    """Out-neighbours (nodes, degree), -1 where fewer: the nearest candidate stays, and those that are alpha times nearer to it than to the node go, until none is left."""
    candidates = _once(np.where(candidates == nodes[:, None], -1, candidates))
    near = np.full(candidates.shape, np.inf, np.float32)
    rows, columns = np.nonzero(candidates >= 0)
    near[rows, columns] = points.apart(points.at[nodes], rows, candidates[rows, columns])
    order = np.argsort(near, axis=1, kind="stable")
    width = int((candidates >= 0).sum(axis=1).max(initial=0))
    candidates, near = np.take_along_axis(candidates, order, 1)[:, :width], np.take_along_axis(near, order, 1)[:, :width]
    at, norms = points.at[np.maximum(candidates, 0)], points.norms[np.maximum(candidates, 0)]
    between = np.maximum(norms[:, :, None] + norms[:, None, :] - 2 * (at @ at.transpose(0, 2, 1)), 0)
    alive = candidates >= 0
    out = np.full((len(nodes), degree), -1, np.int64)
    rows = np.arange(len(nodes))
    for k in range(degree):
        if not alive.any():
            break
        pick = np.argmax(alive, axis=1)
        some = alive[rows, pick]
        out[some, k] = candidates[rows, pick][some]
        alive &= ~((alpha * alpha * between[rows, pick] <= near) & some[:, None])
        alive[rows, pick] = False
    return out


def build_graph(vectors: np.ndarray, p: Params) -> tuple[np.ndarray, int]:
    """(links, entry): points are inserted in batches that double; each is searched for, pruned, and linked back to."""
    points, n = Points(vectors), len(vectors)
    rng = np.random.default_rng(p.seed)
    links = np.full((n, p.degree), -1, np.int64)
    entry = int(points.norms.argmin())
    order = rng.permutation(n)
    order = np.concatenate([[entry], order[order != entry]])
    for again in range(2):  # a second pass sees the whole graph
        at = 1 if not again else 0
        while at < n:
            batch = order[at : at + (min(p.batch, max(1, at)) if not again else p.batch)]
            found, _ = beam_search(points.at[batch], points, links, entry, p.beam)
            links[batch] = robust_prune(batch, np.concatenate([found, links[batch]], axis=1), points, p.alpha, p.degree)
            _link_back(batch, links, points, p)
            at += len(batch)
    return links, entry


def _link_back(batch: np.ndarray, links: np.ndarray, points: Points, p: Params) -> None:
    source = np.repeat(batch, p.degree)
    target = links[batch].ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    nodes, first, count = np.unique(target, return_index=True, return_counts=True)
    slot = np.arange(len(target)) - np.repeat(first, count)
    for low in range(0, int(count.max(initial=0)), 2 * p.degree):  # a hub's new neighbours come in several rounds
        part = (slot >= low) & (slot < low + 2 * p.degree)
        here = nodes[count > low]
        added = np.full((len(here), 2 * p.degree), -1, np.int64)
        added[np.searchsorted(here, target[part]), slot[part] - low] = source[part]
        for k in range(0, len(here), p.batch):
            own = here[k : k + p.batch]
            joint = _once(np.concatenate([links[own], added[k : k + p.batch]], axis=1))
            joint = np.where(joint == own[:, None], -1, joint)
            full = (joint >= 0).sum(axis=1) > p.degree
            packed = np.take_along_axis(joint, np.argsort(joint < 0, axis=1, kind="stable"), 1)[:, : p.degree]
            links[own[~full]] = packed[~full]
            if full.any():
                links[own[full]] = robust_prune(own[full], joint[full], points, p.alpha, p.degree)


def usable_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v array<double>, dim) of the rows whose vector is not null, not empty, not all zero and has only finite components."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    ok = F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return embeddings.where("vec_id is not null").select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(ok).withColumn("dim", F.size("v"))


def _to_pivots(pivots: dict[int, np.ndarray], most: int | None):
    """Adds `cells` to batches that hold vectors `v`: the numbers of the `most` nearest pivots of their length (all if None), nearest first; 0 where a length has none."""

    def run(batches):
        for batch in batches:
            vectors = batch.column(batch.schema.get_field_index("v"))
            cells: list = [None] * len(vectors)
            sizes = np.asarray(vectors.value_lengths())
            for dim in np.unique(sizes):
                rows = np.flatnonzero(sizes == dim)
                if int(dim) not in pivots:
                    for r in rows:
                        cells[r] = [0]
                    continue
                to = pivots[int(dim)]
                x = vectors.filter(pa.array(sizes == dim)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), int(dim))
                for low in range(0, len(rows), 1024):
                    far = (to**2).sum(axis=1)[None] - 2 * (x[low : low + 1024] @ to.T)
                    nearest = np.argsort(far, axis=1, kind="stable")[:, :most]
                    for r, own in zip(rows[low : low + 1024], nearest):
                        cells[r] = own.tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.list_(pa.int32()))], names=[*batch.schema.names, "cells"])

    return run


def _celled(rows: DataFrame, pivots: dict[int, np.ndarray], most: int | None) -> DataFrame:
    return rows.mapInArrow(_to_pivots(pivots, most), T.StructType([*rows.schema.fields, T.StructField("cells", T.ArrayType(T.IntegerType()))]))


def choose_pivots(distinct: DataFrame, params: Params) -> dict[int, np.ndarray]:
    """Vectors by length, about one for each `shard_rows` and no more than about `most_pivots`, chosen by hash: the bounded sample that the regions come from."""
    p = params
    sizes = distinct.groupBy("dim").agg(F.count("*").alias("n"))
    every = F.greatest(F.lit(p.shard_rows), F.ceil(F.sum("n").over(Window.partitionBy()) / p.most_pivots)).cast("long")
    chosen = distinct.join(F.broadcast(sizes.select("dim", every.alias("every"))), "dim").where(F.pmod(F.xxhash64("key", F.lit(13)), "every") == 0)
    out: dict[int, list] = {}
    for dim, v in chosen.select("dim", "v").orderBy("dim", "key").toLocalIterator():
        out.setdefault(dim, []).append(v)
    return {dim: np.array(v, np.float64) for dim, v in out.items()}


@dataclass(frozen=True)
class Index:
    """`nodes`: (shard, node, entry, links, v, ids) for each distinct vector; `shards`: (dim, cell, shard); `pivots`: the cells' centres by length."""

    nodes: DataFrame
    shards: DataFrame
    pivots: dict[int, np.ndarray]


def build_index(embeddings: DataFrame, params: Params = Params()) -> Index:
    """A graph for each shard of the distinct vectors: a vector's place in it, its out-neighbours' places, and the smallest vec_ids that have it.

    Equal vectors share a node with the k + 1 smallest of their different ids, so that no other copy can be among a query's k nearest;
    repeated rows are folded before ids are ranked, and ids are ranked in salted groups first. A vector belongs to the region of its nearest
    pivot; a region of over `shard_rows` vectors is dealt to several shards by hash. Each shard is built by a task of its own.
    """
    p = params
    usable = usable_vectors(embeddings).withColumn("key", F.xxhash64("v"))
    near = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy("vec_id"))
    few = usable.select("key", "vec_id", "v", "dim").distinct().withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(64)))
    few = few.withColumn("r", near("key", "v", "salt")).where(f"r <= {p.k + 1}").withColumn("r", near("key", "v")).where(f"r <= {p.k + 1}")
    distinct = materialise(few.groupBy("key", "v", "dim").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "vectors")
    pivots = choose_pivots(distinct, p)
    placed = materialise(_celled(distinct, pivots, 1).select("key", "v", "dim", "ids", F.get("cells", F.lit(0)).alias("cell")), "placed")
    parts = placed.groupBy("dim", "cell").agg(F.ceil(F.count("*") / p.shard_rows).cast("int").alias("parts"))  # a row for each pivot
    name = lambda part: F.concat_ws("/", "dim", "cell", part)
    dealt = placed.join(F.broadcast(parts), ["dim", "cell"]).select(name(F.pmod(F.xxhash64("key", F.lit(7)), "parts")).alias("shard"), "v", "ids")
    shards = materialise(parts.select("dim", "cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).select("dim", "cell", name("part").alias("shard")).coalesce(1), "shards")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        links, entry = build_graph(np.array(pdf["v"].tolist(), np.float64), p)
        return pd.DataFrame({"shard": pdf["shard"], "node": np.arange(len(pdf)), "entry": np.arange(len(pdf)) == entry, "links": [row[row >= 0] for row in links], "v": pdf["v"], "ids": pdf["ids"]})

    tasks = min(10_000, max(1, shards.count()))
    spread = dealt.repartitionByRange(tasks, "shard")
    nodes = spread.groupBy("shard").applyInPandas(build, "shard string, node long, entry boolean, links array<long>, v array<double>, ids array<long>")
    return Index(materialise(nodes, "graph"), shards, pivots)


def search_index(index: Index, queries: DataFrame, params: Params = Params()) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of each query (query_id, v, dim) among the index, itself left out; ties go to the smaller vec_id.

    A query visits all shards, or with `probes` those of the regions whose pivots are nearest, which loses neighbours where regions are not well apart.
    Shards that more than `query_block` queries visit are searched in blocks. An id that has several vectors counts by its nearest.
    """
    p = params
    visits = _celled(queries, index.pivots, p.probes).select("query_id", F.col("v").alias("q"), "dim", F.explode("cells").alias("cell"))
    asked = visits.join(F.broadcast(index.shards), ["dim", "cell"]).select(F.col("shard").alias("of_shard"), "query_id", "q")
    asked = materialise(asked, "asked")
    loads = asked.groupBy("of_shard").agg(F.ceil(F.count("*") / p.query_block).cast("int").alias("blocks"))
    blocks = loads.agg(F.max("blocks")).first()[0] or 1
    nodes = index.nodes.withColumn("block", F.lit(0))
    asked = asked.withColumn("of_block", F.lit(0))
    if blocks > 1:
        spread = loads.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        nodes = nodes.drop("block").join(spread.select(F.col("of_shard").alias("shard"), "block"), "shard")
        asked = asked.drop("of_block").join(loads, "of_shard").withColumn("of_block", F.pmod(F.xxhash64("query_id", F.lit(3)), "blocks").cast("int")).drop("blocks")

    def search(nodes: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(nodes) and len(asked):
            nodes = nodes.sort_values("node")
            vectors = np.array(nodes["v"].tolist(), np.float64)
            points = Points(vectors)
            width = max(1, max(map(len, nodes["links"])))
            links = np.full((len(nodes), width), -1, np.int64)
            for k, row in enumerate(nodes["links"]):
                links[k, : len(row)] = row
            entry = int(np.flatnonzero(nodes["entry"].to_numpy())[0])
            ids, targets = nodes["ids"].tolist(), np.array(asked["q"].tolist(), np.float64)
            for low in range(0, len(asked), p.batch):
                part = targets[low : low + p.batch]
                found, _ = beam_search(points.placed(part), points, links, entry, p.query_beam)
                for query, q, row in zip(asked["query_id"].iloc[low : low + p.batch].tolist(), part, found):
                    row = row[row >= 0]
                    exact = np.sqrt(((vectors[row] - q) ** 2).sum(axis=1))
                    nearest_of: dict = {}
                    for s, i in sorted((s, i) for s, n in zip(exact.tolist(), row.tolist()) for i in ids[n] if i != query):
                        nearest_of.setdefault(i, s)
                    for i, s in list(nearest_of.items())[: p.k]:
                        out["query_id"].append(query)
                        out["vec_id"].append(i)
                        out["score"].append(s)
        return pd.DataFrame(out)

    met = nodes.groupBy("shard", "block").cogroup(asked.groupBy("of_shard", "of_block")).applyInPandas(search, "query_id long, vec_id long, score double")
    met = met.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return met.withColumn("rank", rank).where(f"rank <= {p.k}").select("query_id", "rank", "vec_id", "score")


def nearest(embeddings: DataFrame, is_query, params: Params = Params()) -> DataFrame:
    """The k nearest other rows of each row of `embeddings` (vec_id, embedding) for which the condition `is_query` holds, by Euclidean distance.

    Null ids and vectors that are null, empty, zero or hold null or non-finite components take no part. Repeated
    rows count once; equal vectors under other ids are neighbours at distance 0. An id with several vectors asks with the first of
    them by hash, then by components, and is found once, at its nearest. An empty table gives an empty result.
    """
    queries = usable_vectors(embeddings.where(is_query)).groupBy(F.col("vec_id").alias("query_id")).agg(F.min(F.struct(F.xxhash64("v").alias("h"), "v", "dim")).alias("m")).select("query_id", "m.v", "m.dim")
    queries = materialise(queries, "queries")
    return search_index(build_index(embeddings, params), queries, params)
