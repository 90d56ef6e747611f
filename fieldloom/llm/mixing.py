"""Mixing sources to target weights: iterative proportional fitting over cells, then sampling by calibrated probabilities."""

from __future__ import annotations

import warnings
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise


@dataclass(frozen=True)
class Targets:
    """Wanted shares of tokens, for each dimension a value's share; values not named share what is left, as one class named None.

    Targets that contradict each other or the cells that there are do not settle: if factors still move by over `close` of themselves after
    `rounds`, a warning says so, or an error if `strict`.
    """

    shares: dict[str, dict[str, float]]
    rounds: int = 30
    seed: str = "mix-1"
    close: float = 1e-4
    strict: bool = False


def with_topics(docs: DataFrame, lists: dict[str, list[str]], default: str | None = None, text: str = "text") -> DataFrame:
    """`docs` with `__words`, the number of words of the whole text, and `__topic`, the topic with the most words of its list there.

    Of equal topics it is the first by name, and `default` where no list has a word in the text. Words lie between ASCII white space and
    are lower-cased; lists are given by the caller, in lower case. A text is cut once, and only words of some list are told apart by topic.
    """
    docs = docs.drop("__words", "__topic")
    every = sorted({w for words in lists.values() for w in words})
    cut = docs.withColumn("__cut", F.split(F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), r"[\x20\x09-\x0D]"))
    held = cut.select(*docs.columns, F.size(F.filter("__cut", lambda w: w != "")).cast("long").alias("__words"), F.filter("__cut", lambda w: w.isin(every)).alias("__held"))

    def counted(topic: str) -> Column:
        return F.struct((-F.size(F.filter("__held", lambda w: w.isin(lists[topic])))).alias("less"), F.lit(topic).alias("topic"))

    none = F.struct(F.lit(0).alias("less"), F.lit(None).cast("string").alias("topic"))  # sorts before the topics without a word
    best = F.array_min(F.array(none, *(counted(t) for t in sorted(lists))))["topic"]
    return held.select(*docs.columns, "__words", F.coalesce(best, F.lit(default)).alias("__topic"))


def drawn_number(doc_id: str, seed: str) -> Column:
    """A number of 32 bits that depends on the id and the seed alone; a null id draws as the text `null`."""
    digest = F.md5(F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.lit(seed)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def classed(column: Column, shares: dict[str, float]) -> Column:
    """The value itself where it has a target, else null."""
    return F.when(column.isin(*shares), column)


#: Rounds of raking that one job takes.
_BLOCK = 10


def rake(cells: DataFrame, targets: Targets) -> DataFrame:
    """`cells` (a column for each dimension, tokens) with `weight`, the raked share of all tokens that a cell is to have.

    Each half-step multiplies the cells by wanted / present share of one dimension. The cells, as many as the product of the targets' classes
    at most, are one partition, so that the half-steps of ten rounds are windows of one stage; between such blocks the weights go to the
    shared folder, and only their greatest move reaches the driver. Classes without tokens give up their share to the others of their dimension.
    """
    dims, live = list(targets.shares), F.col("tokens") > 0
    now = cells.coalesce(1).withColumn("weight", F.when(live, F.col("tokens").cast("double")).otherwise(0.0))
    for d in dims:
        rest = max(0.0, 1 - sum(targets.shares[d].values()))
        wanted = reduce(lambda w, kv: w.when(F.col(d) == kv[0], F.lit(float(kv[1]))), targets.shares[d].items(), F.when(F.lit(False), F.lit(0.0))).otherwise(F.lit(rest))
        now = now.withColumn(f"__want_{d}", F.when(live, wanted))
        part = F.col(f"__want_{d}") / F.sum(live.cast("int")).over(Window.partitionBy(d))  # a class counts once, however many cells it has
        now = now.withColumn("__part", part).withColumn(f"__want_{d}", F.try_divide(F.col(f"__want_{d}"), F.sum("__part").over(Window.partitionBy()))).drop("__part")
    taken, moved = 0, 0.0
    while taken < targets.rounds:
        block = min(_BLOCK, targets.rounds - taken)
        for k in range(block):
            now = now.withColumn("__move", F.lit(0.0)) if k == block - 1 else now
            for d in dims:
                now = now.withColumn("__step", F.coalesce(F.try_divide(F.col(f"__want_{d}"), F.sum("weight").over(Window.partitionBy(d))), F.lit(0.0)))
                moves = [F.greatest("__move", F.when(live, F.abs(F.col("__step") - 1)).otherwise(0.0)).alias("__move")] if k == block - 1 else []
                now = now.select(*(c for c in now.columns if c not in ("weight", "__step", *(["__move"] if moves else []))), (F.col("weight") * F.col("__step")).alias("weight"), *moves)
        now = materialise(now, "raked").coalesce(1)
        moved = now.agg(F.max("__move")).first()[0] or 0.0
        taken += block
        if moved < 1e-10:
            break
    if moved > targets.close:
        said = f"raking did not settle in {taken} rounds: a class is still moved by {moved:.1e} of itself"
        if targets.strict:
            raise RuntimeError(said)
        warnings.warn(said, stacklevel=2)
    return now.select(*cells.columns, "weight")


#: Buckets of draws for which tokens are counted before the cuts are looked for.
_BUCKET_BITS = 12


def cuts(ready: DataFrame, counts: DataFrame, quotas: DataFrame, dims: list[str]) -> DataFrame:
    """(dims, __cut) for each cell of `quotas` (dims, quota): the draw below which the cell's documents hold as many tokens as its quota, to within half a document.

    Documents are in order of their draws; one stays if the tokens before it and half its own are below the quota. `counts` (dims, bucket, tokens) tells the
    bucket of draws in which that ends, and only its documents (`ready`: dims, draw, tokens), one of thousands, are put in order. Equal draws stay or go together.
    """
    same = lambda other: reduce(lambda x, y: x & y, (F.col(d).eqNullSafe(F.col(f"__{d}")) for d in dims), F.lit(True)) & other
    keyed = quotas.where("quota > 0").select(*(F.col(d).alias(f"__{d}") for d in dims), "quota")
    before = F.coalesce(F.sum("tokens").over(Window.partitionBy(*dims).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    met = counts.withColumn("before", before).join(keyed, same(F.col("before") < F.col("quota")))
    last = met.groupBy(*dims).agg(F.max_by(F.struct("bucket", "before", "quota"), "bucket").alias("b"))
    last = materialise(last.select(*(F.col(d).alias(f"__{d}") for d in dims), "b.*"), "last")
    own = ready.join(last, same(F.shiftright("draw", 32 - _BUCKET_BITS) == F.col("bucket"))).groupBy(*dims, "draw", "before", "quota").agg(F.sum("tokens").alias("t"))
    so_far = F.col("before") + F.sum("t").over(Window.partitionBy(*dims).orderBy("draw").rowsBetween(Window.unboundedPreceding, 0))
    kept = own.withColumn("stays", 2 * so_far - F.col("t") < 2 * F.col("quota")).where("stays").groupBy(*dims).agg(F.max("draw").alias("cut"))
    found = last.select(*(F.col(f"__{d}").alias(d) for d in dims), "bucket")
    begins = F.shiftleft(F.col("bucket").cast("long"), 32 - _BUCKET_BITS)
    out = found.join(kept.select(*(F.col(d).alias(f"__{d}") for d in dims), "cut"), same(F.lit(True)), "left")
    return out.select(*dims, ((F.coalesce("cut", begins - 1) + 0.5) / F.lit(2.0**32)).alias("__cut"))


def mix(docs: DataFrame, targets: Targets, dims: dict[str, Column], tokens: Column) -> DataFrame:
    """`docs` with `__tokens`, `__cell` (struct of the classes), `__ratio` (wanted over present share of the cell), `__probability`, `__draw` and `__cut`.

    A document is to be kept if `__draw < __cut`. Probabilities are the ratios over the greatest one, so that kept tokens meet the raked shares without
    any document being repeated. Within a cell documents are taken in order of their draws until the cell has its quota of tokens (its probability of
    all it has), so that what is kept misses its share by half a document, not by chance. Documents over half of their cell's quota are taken first, up to
    their own part of it, and the others fill up what these leave; both cuts are about the probability where cells are large. Null values of a dimension fall into its
    class of the values not named, as do empty texts by their own values; documents without tokens weigh nothing and are kept as their draws are,
    in a cell without tokens never. Repeated rows draw alike and count each. An empty table gives an empty result. Columns of these names are replaced.

    Tokens are summed to cells and buckets of draws where they are read, so that a hot source shuffles some thousand rows for each task and cell; the cells'
    figures are broadcast behind a check of their number, which the product of the targets' classes bounds.
    """
    docs = docs.drop("__tokens", "__cell", "__ratio", "__probability", "__draw", "__cut", "__long_cut", "__short_cut", "__number", "__key", "__quota")
    names = list(targets.shares)
    cells_bound = reduce(lambda x, d: x * (len(targets.shares[d]) + 1), targets.shares, 1)
    ready = docs.select("*", tokens.alias("__tokens"), F.struct(*(classed(dims[d], targets.shares[d]).alias(d) for d in names)).alias("__cell"), drawn_number("doc_id", targets.seed).alias("__number"))
    narrow = ready.select(*(F.col(f"__cell.{d}").alias(d) for d in names), F.col("__number").alias("draw"), F.col("__tokens").alias("tokens"))
    cells = materialise(narrow.groupBy(*names).agg(F.sum("tokens").alias("tokens")), "cells")
    raked = rake(cells, targets)
    total = F.lit(float(cells.agg(F.sum("tokens")).first()[0] or 0))
    ratios = raked.withColumn("ratio", F.when(F.col("tokens") > 0, F.col("weight") * total / F.col("tokens")).otherwise(0.0))
    greatest = ratios.agg(F.max("ratio")).first()[0] or 1.0
    ratios = ratios.select(*names, "tokens", F.col("ratio").alias("__ratio"), (F.col("ratio") / F.lit(greatest)).alias("__probability"))
    ratios = materialise(ratios.withColumn("quota", F.col("__probability") * F.col("tokens")).coalesce(1), "ratios")
    small = (lambda df: F.broadcast(df)) if cells_bound <= 1_000_000 else (lambda df: df)
    key = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})

    halves = small(ratios.select(key.alias("__key"), "quota"))
    split = narrow.withColumn("__key", key).join(halves, "__key").withColumn("long", 2 * F.col("tokens") > F.col("quota")).drop("__key", "quota")
    counts = materialise(split.groupBy(*names, "long", F.shiftright("draw", 32 - _BUCKET_BITS).alias("bucket")).agg(F.sum("tokens").alias("tokens")), "counts")
    shares = counts.where("long").groupBy(*names).agg(F.sum("tokens").alias("long_tokens"))
    long_quotas = shares.withColumn("__key", key).join(small(ratios.select(key.alias("__key"), "__probability")), "__key").select(*names, (F.col("__probability") * F.col("long_tokens")).alias("quota"))
    long_cuts = materialise(cuts(split.where("long"), counts.where("long"), long_quotas, names).withColumn("__key", key).select("__key", F.col("__cut").alias("__long_cut")).coalesce(1), "longcuts")
    taken = split.where("long").withColumn("__key", key).join(small(long_cuts), "__key").where(F.col("draw") / F.lit(2.0**32) < F.col("__long_cut")).groupBy("__key").agg(F.sum("tokens").alias("taken"))
    rest = ratios.withColumn("__key", key).join(taken, "__key", "left").select(*names, (F.col("quota") - F.coalesce("taken", F.lit(0))).alias("quota"))
    short_cuts = cuts(split.where("not long"), counts.where("not long"), rest, names).select(key.alias("__key"), F.col("__cut").alias("__short_cut"))
    figures = ratios.select(key.alias("__key"), "__ratio", "__probability", F.col("quota").alias("__quota")).join(long_cuts, "__key", "left").join(short_cuts, "__key", "left")
    figures = materialise(figures.coalesce(1), "figures")
    keyed = ready.withColumn("__key", F.to_json("__cell", {"ignoreNullFields": "false"}))
    cut = F.when(2 * F.col("__tokens") > F.col("__quota"), F.col("__long_cut")).otherwise(F.col("__short_cut"))
    joined = keyed.join(small(figures), "__key").withColumn("__cut", F.coalesce(cut, F.lit(0.0))).drop("__key", "__long_cut", "__short_cut", "__quota")
    return joined.withColumn("__draw", F.col("__number") / F.lit(2.0**32)).drop("__number")
