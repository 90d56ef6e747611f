"""Shared pieces: intermediate tables in the cluster's shared folder, and word hashing in numpy."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of a text: runs of anything but ASCII white space. `bytes.split()` cuts at the same six bytes.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = b" \t\n\r\x0b\x0c"

_own_root: str | None = None


def shared_root(spark: SparkSession) -> str:
    """The folder in `spark.checkpoint.dir`, or else the checkpoint folder of the context, which driver and executors share.

    Only a session on one machine gets a folder of its own where both are unset; a cluster without one is an error.
    """
    global _own_root
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if _own_root is None:
        _own_root = "file://" + tempfile.mkdtemp(prefix="spark-fieldloom-")
    return _own_root


#: Paths of the tables written by this application, in order.
_written: list[str] = []


def _filesystem(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def materialise(df: DataFrame, label: str) -> DataFrame:
    """`df` written to the shared folder and read back: lineage is cut, nothing is computed twice, and a lost executor costs a re-read.

    The folder goes when the application ends, or with `materialised_alone`.
    """
    spark = df.sparkSession
    path = f"{shared_root(spark)}/fieldloom-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append(path)
    fs, target = _filesystem(spark, path)
    fs.deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def materialised_alone(spark: SparkSession, make, label: str, last: DataFrame | None = None) -> DataFrame:
    """`make()` written as a table, after which the tables that were written for it, and that of `last`, are deleted."""
    before = len(_written)
    out = materialise(make(), label)
    own = _written.pop()
    gone, kept = _written[before:], _written[:before]
    if last is not None and kept:
        files = last.inputFiles()
        gone += [p for p in kept if files and p.rsplit("/", 1)[1] in files[0]]
    for path in gone:
        fs, target = _filesystem(spark, path)
        fs.delete(target, True)
    _written[:] = [*(p for p in kept if p not in gone), own]
    return out


def mixed_bits(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit words whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_CODES = mixed_bits(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_LOWER_CODES = _BYTE_CODES[_LOWER]
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_BASE = 0x9FB21C651E98DF25
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


class WordHasher:
    """64-bit hashes of all words of a buffer by prefix sums of a polynomial; equal words get equal hashes in every process."""

    def __init__(self, lower: bool = True, segment: int = 1 << 19, breaks: np.ndarray = _IS_SPACE):
        """`breaks` tells of each byte whether it stands between words."""
        self.codes = _LOWER_CODES if lower else _BYTE_CODES
        self.segment, self.breaks = segment, breaks
        self._grow(1 << 12)

    def _grow(self, n: int) -> None:
        self.powers = np.cumprod(np.full(n, _BASE, np.uint64), dtype=np.uint64)
        self.inverses = np.cumprod(np.full(n, _BASE_INVERSE, np.uint64), dtype=np.uint64)

    def _segments(self, data: np.ndarray):
        """(offset, start offsets, stop offsets, prefix sums) of segments cut at white space, so that no word is cut."""
        at = 0
        while at < len(data):
            end = min(len(data), at + self.segment)
            while end < len(data):
                gap = np.flatnonzero(self.breaks[data[end : end + self.segment]])
                if len(gap):
                    end += int(gap[0])
                    break
                end = min(len(data), end + self.segment)
            part = data[at:end]
            edge = np.diff(np.concatenate(([0], (~self.breaks[part]).view(np.int8), [0])))
            if len(part) > len(self.powers):
                self._grow(len(part) * 2)
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(self.codes[part] * self.powers[: len(part)], out=sums[1:])
            yield at, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), sums
            at = end

    def _hashed(self, sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mixed_bits((sums[stop] - sums[start]) * self.inverses[start] + (stop - start).astype(np.uint64))

    def words(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and start offsets of the words of `data` (uint8), worked through in segments."""
        parts = [(self._hashed(sums, start, stop), start + at) for at, start, stop, sums in self._segments(data)]
        if not parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return np.concatenate([h for h, _ in parts]), np.concatenate([s for _, s in parts])

    def words_and_beginnings(self, data: np.ndarray, sizes: tuple[int, ...]):
        """Yields (whole, hashes, start offsets): the words, then the beginnings of each size of words that are long enough, hashed as words are."""
        for at, start, stop, sums in self._segments(data):
            yield True, self._hashed(sums, start, stop), start + at
            for n in sizes:
                own = start[stop - start >= n]
                yield False, self._hashed(sums, own, own + n), own + at


def windows(words: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all runs of `size` words, one for each start."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[k : k + n]
    return mixed_bits(out)


class Rolling:
    """64-bit hashes of all runs of a number of words, by prefix sums, so that long runs cost no more than short ones."""

    def __init__(self, salt: int = 0):
        self.salt = np.uint64(salt)
        self._grow(1 << 12)

    def _grow(self, n: int) -> None:
        self.powers = np.cumprod(np.full(n, _BASE, np.uint64), dtype=np.uint64)
        self.inverses = np.cumprod(np.full(n, _BASE_INVERSE, np.uint64), dtype=np.uint64)

    def runs(self, words: np.ndarray, size: int) -> np.ndarray:
        """One hash for each start of a run of `size` words; hashes of other salts are independent."""
        n = len(words) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        if len(words) > len(self.powers):
            self._grow(2 * len(words))
        sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(mixed_bits(words ^ self.salt) * self.powers[: len(words)], out=sums[1:])
        return mixed_bits((sums[size:] - sums[:n]) * self.inverses[:n] + np.uint64(size))


def shingle_set(words: np.ndarray, size: int = 5) -> np.ndarray:
    """The sorted distinct shingles of `size` words; with fewer words, the whole sequence as one; without words, none."""
    if len(words) == 0:
        return np.zeros(0, np.uint64)
    return np.unique(windows(words, min(size, len(words))) + np.uint64(min(size, len(words))))


def text_groups(texts, limit: int = 1 << 19):
    """Runs (first, last, buffer, offsets) of a binary Arrow array of about `limit` bytes; a null counts as empty."""
    first, size, parts = 0, 0, []
    for k, value in enumerate(texts):
        piece = value.as_py() or b""
        parts.append(piece)
        size += len(piece) + 1
        if size >= limit:
            yield first, parts
            first, size, parts = k + 1, 0, []
    if parts:
        yield first, parts


def grouped_words(hasher: WordHasher, parts: list[bytes]):
    """The word hashes of each text of `parts`, found in one pass over their concatenation."""
    joined = np.frombuffer(b"\n".join(parts), np.uint8)
    hashes, starts = hasher.words(joined)
    ends = np.cumsum(np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts)))
    cuts = np.searchsorted(starts, ends)
    low = 0
    for high in cuts:
        yield hashes[low:high]
        low = high


def released(run):
    """`run` over a task's batches, after which memory that is no longer needed goes back to the system: the worker stays, for other stages too."""

    def whole(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return whole


def rows_within(df: DataFrame, key: str, ids: DataFrame, id_column: str, most: int = 500_000) -> DataFrame:
    """Rows of `df` whose `key` is among the distinct ids. Up to `most` ids (8 MB) are broadcast, so that texts stay where they are; beyond, both sides are shuffled."""
    ids = ids.select(F.col(id_column).alias("__id"))
    small = ids.limit(most + 1).count() <= most
    return df.join(F.broadcast(ids) if small else ids, df[key] == F.col("__id"), "left_semi")
