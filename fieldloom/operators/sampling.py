"""Seeded orders of a table for several readers, without a shuffle of the rows: each row's place is computed from its index."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scans import PART, in_ranges, running_sums

ROUNDS = 4
#: Steps after which a walk has come back into the range; each leaves it with a chance of about one in the root of the number of rows.
WALK = 24


def sides(n: int) -> tuple[int, int]:
    """a, b with a * b at least n, by less than a."""
    a = max(1, math.isqrt(max(0, n - 1)) + 1) if n > 1 else 1
    return a, max(1, -(-n // a))


def _mixed(seed: str, turn: Column, x: Column) -> Column:
    digest = F.md5(F.concat_ws(":", F.lit(seed), turn.cast("string"), x.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def permuted(index: Column, n: int, seed: str) -> Column:
    """A bijection of 0..n-1 that depends on the seed: two halves of the number are moved by each other's mixed values, again and again while the result is beyond n."""
    a, b = sides(n)

    def once(x: Column) -> Column:
        def half(state: Column, k: Column) -> Column:
            even = F.pmod(state["l"] + _mixed(seed, k, state["r"]), F.lit(a))
            odd = F.pmod(state["r"] + _mixed(seed, k, state["l"]), F.lit(b))
            return F.when(k % 2 == 0, F.struct(even.alias("l"), state["r"].alias("r"))).otherwise(F.struct(state["l"].alias("l"), odd.alias("r")))

        start = F.struct(F.pmod(x, F.lit(a)).cast("long").alias("l"), F.floor(x / a).cast("long").alias("r"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(2 * ROUNDS - 1)), start, half, lambda s: s["r"] * a + s["l"])

    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), once(index.cast("long")), lambda x, _: F.when(x < n, x).otherwise(once(x)))
    return F.when(walked < n, walked).otherwise(F.raise_error(F.lit("a walk did not come back")).cast("long"))


def indexed(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """`rows` with a gapless `index` from 0 in an order that tells them apart, and their number; no task holds all of them."""
    ranged = in_ranges(rows, [], order)
    counted = running_sums(ranged, [], order, {"__n": F.lit(1)})
    return counted.withColumn("index", F.col("__n").cast("long") - 1).drop("__n", PART), ranged.count()


def strided(rows: DataFrame, order: list[str], world: int, epoch: int = 0, seed: str = "0") -> DataFrame:
    """`rows` with `place`, `reader` and `step` in an epoch of an endless shuffled stream that `world` readers share.

    Epoch e of n rows fills the places from e * n on, in an order of its own that seed and epoch decide; reader r takes the places r, r + world, ...,
    of which a row is the `step`-th. So readers are disjoint, each epoch is complete, and any reader can begin at any place again.
    """
    numbered, n = indexed(rows, order)
    place = permuted(F.col("index"), n, f"{seed}:{epoch}") + F.lit(epoch * n)
    return numbered.withColumn("place", place).withColumn("reader", (F.col("place") % world).cast("int")).withColumn("step", F.floor(F.col("place") / world)).drop("index")


def shard_of(rows: DataFrame, order: list[str], rank: int, world: int, epoch: int = 0, seed: str = "0") -> DataFrame:
    """The rows of one reader of `strided`, with their places and steps."""
    return strided(rows, order, world, epoch, seed).where(F.col("reader") == rank)
