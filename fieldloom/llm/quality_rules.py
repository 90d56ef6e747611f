"""Quality rules: counts over words and lines, and zstandard ratios in bands that depend on length."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WordHasher, grouped_words, released, text_groups, windows

_SYMBOLS = b"#*$%&|<>"
_WHITE = b" \t\n\r\x0b\x0c"


@dataclass(frozen=True)
class Limits:
    """Rules for words, and bands of compression ratios (bytes / compressed bytes).

    `bands` holds (under so many bytes, least ratio, greatest ratio) for whole texts, `chunk_bands` the same for the pieces of `chunk` bytes
    that a text is cut into, its shorter last piece included. A text outside its band fails, and so does one of which over
    `chunk_share` of the bytes lie in pieces outside theirs.
    """

    least_words: int = 10
    most_repeated_percent: int = 20
    window: int = 5
    level: int = 3
    chunk: int = 4096
    chunk_share: float = 0.2
    chunk_bands: tuple[tuple[float, float, float], ...] = (
        (100, 0.0, 2.0),
        (300, 0.85, 2.2),
        (600, 1.1, 2.4),
        (1500, 1.2, 2.7),
        (4000, 1.35, 2.9),
        (float("inf"), 1.35, 3.2),
    )
    bands: tuple[tuple[float, float, float], ...] = (
        (100, 0.0, 2.0),
        (300, 0.85, 2.2),
        (600, 1.1, 2.4),
        (1500, 1.2, 2.7),
        (4000, 1.35, 2.9),
        (16000, 1.5, 3.1),
        (float("inf"), 1.5, 3.4),
    )


def repeated_words(words: np.ndarray, size: int) -> int:
    """Words that lie in a run of `size` words found twice or more."""
    runs = windows(words, size)
    if len(runs) < 2:
        return 0
    order = np.argsort(runs, kind="stable")
    same = runs[order][1:] == runs[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(runs) + 1, np.int64)
    twice[order[1:][same]] = 1
    twice[order[:-1][same]] = 1
    covered = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + size, -1)
    return int((np.cumsum(covered) > 0)[: len(words)].sum())


def _duplicate_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip(_WHITE)]
    return len(lines) - len(set(lines))


def _ratio(compressor, piece: bytes) -> float:
    return len(piece) / len(compressor.compress(piece))


def _outside(size: int, ratio: float, bands) -> bool:
    low, high = next((a, b) for most, a, b in bands if size < most)
    return not low <= ratio <= high


def compression_verdict(compressor, text: bytes, limits: Limits) -> tuple[float, float, bool]:
    """The ratio of the whole text, the share of its bytes in pieces outside their band, and whether both are within bounds."""
    if not text:
        return 0.0, 0.0, True
    whole = _ratio(compressor, text)
    pieces = [text[k : k + limits.chunk] for k in range(0, len(text), limits.chunk)]
    ratios = [whole] if len(pieces) == 1 else [_ratio(compressor, c) for c in pieces]
    share = sum(len(c) for c, r in zip(pieces, ratios) if _outside(len(c), r, limits.chunk_bands)) / len(text)
    return whole, share, not _outside(len(text), whole, limits.bands) and share <= limits.chunk_share


_MEASURES = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long", "base_failed": "boolean", "kept": "boolean", "ratio": "double", "bad_chunk_share": "double"}


def _measured(limits: Limits, at: int):
    def run(batches):
        hasher, compressor = WordHasher(lower=False), zstandard.ZstdCompressor(level=limits.level)
        for batch in batches:
            for first, parts in text_groups(batch.column(at).cast(pa.binary())):
                rows = []
                for text, words in zip(parts, grouped_words(hasher, parts)):
                    n = len(words)
                    points = len(text.translate(None, bytes(range(0x80, 0xC0)) + _WHITE))
                    symbols = len(text) - len(text.translate(None, _SYMBOLS))
                    repeated = repeated_words(words, limits.window)
                    failed = n < limits.least_words or 100 * repeated > limits.most_repeated_percent * n
                    ratio, share, within = compression_verdict(compressor, text, limits)
                    rows.append((n, points, symbols, _duplicate_lines(text), repeated, failed, not failed and within, ratio, share))
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(first, len(parts)) for c in batch.columns), *(pa.array([r[k] for r in rows]) for k in range(len(_MEASURES)))],
                    names=[*batch.schema.names, *(f"__q_{m}" for m in _MEASURES)],
                )

    return run


def with_quality(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """`docs` with the measures of each text in columns `__q_n_words` ... `__q_kept`; see `quality` for what they mean. Columns of these names are replaced; an empty table stays empty."""
    docs = docs.drop(*(f"__q_{m}" for m in _MEASURES))
    docs = docs.withColumn("text", F.col("text").cast("string"))
    schema = T.StructType(list(docs.schema.fields))
    for name, kind in _MEASURES.items():
        schema.add(f"__q_{name}", kind)
    return docs.mapInArrow(released(_measured(limits, docs.columns.index("text"))), schema)


def quality(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, ratio, bad_chunk_share) for each row.

    Words are runs of anything but ASCII white space, word_chars their code points, n_symbols the characters `#*$%&|<>`,
    n_dup_lines the lines with a word that equal an earlier line, n_repeat_words the words in runs of five found twice
    or more. kept is false if base_failed, or if the compression ratio of the text, or of pieces with too many of its bytes, is outside its band.
    A null or empty text has zero words, so that it fails. Texts are worked through whole, in groups of half a
    megabyte; repeated rows are each judged. An empty table gives an empty result.
    """
    judged = with_quality(docs.select("doc_id", "text"), limits)
    return judged.select("doc_id", *(F.col(f"__q_{m}").alias(m) for m in _MEASURES))
