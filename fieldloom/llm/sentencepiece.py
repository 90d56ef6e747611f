"""SentencePiece encoding and decoding: Viterbi over a vocabulary of scored pieces, equal-length words in step."""

from __future__ import annotations

from array import array
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import mixed_bits, released

#: SentencePiece's mark of a space, and the penalty of a character outside the vocabulary below the least score.
MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Stands for the mark where a text has that very character, so that it becomes bytes and not a space; no text can hold it.
_WRITTEN_MARK = "\ud800"


@dataclass(frozen=True)
class Vocabulary:
    """Normal pieces with scores; ids of the 256 byte pieces; the unknown id."""

    pieces: tuple[str, ...]
    ids: np.ndarray
    scores: np.ndarray
    byte_ids: np.ndarray
    unknown: int
    names: tuple[str, ...]


def load_vocabulary(model_file: str) -> Vocabulary:
    """Reads a SentencePiece model file on the driver; the vocabulary (tens of thousands of pieces) travels with the tasks."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=model_file)
    names = tuple(m.id_to_piece(k) for k in range(len(m)))
    normal = [k for k in range(len(m)) if not (m.is_byte(k) or m.is_control(k) or m.is_unknown(k) or m.is_unused(k))]
    byte_ids = np.array([m.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
    return Vocabulary(tuple(names[k] for k in normal), np.array(normal, np.int32), np.array([m.get_score(k) for k in normal], np.float64), byte_ids, m.unk_id(), names)


_BASE = 0x9FB21C651E98DF25


class Encoder:
    """Encodes words in batches. A word is a run of marks with what follows up to the next mark; no piece of the vocabulary spans two.

    Words over `long` characters are solved in blocks of positions and not remembered.
    """

    def __init__(self, vocabulary: Vocabulary, most_cached: int = 150_000, long: int = 400):
        v = vocabulary
        self.long = long
        self.v = v
        self.longest = max(map(len, v.pieces), default=1)
        # The pieces' own codes, with which each hit is confirmed, and their rolling hashes.
        sizes = np.array([len(p) for p in v.pieces], np.int64)
        letters = np.zeros((len(v.pieces), self.longest), np.uint64)
        letters[np.arange(self.longest) < sizes[:, None]] = self._codes("".join(v.pieces))
        keys = np.zeros(len(v.pieces), np.uint64)
        for k in range(self.longest):
            keys = np.where(sizes > k, keys * np.uint64(_BASE) + letters[:, k], keys)
        order = np.argsort(keys)
        self.keys, self.sizes, self.letters = keys[order], sizes[order], letters[order]
        self.piece_ids, self.piece_scores = v.ids[order], v.scores[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces of the vocabulary are equal or have equal hashes")
        # Where the sorted keys with the same top 20 bits begin, or -1: most substrings are no piece, and few keys share these bits.
        top = (self.keys >> np.uint64(44)).astype(np.int64)
        self.first = np.full(1 << 20, -1, np.int32)
        self.first[top[::-1]] = np.arange(len(top), dtype=np.int32)[::-1]
        self.most_alike = int(np.bincount(top).max(initial=1))
        self.unknown_score = (v.scores.min() if len(v.scores) else 0.0) - UNKNOWN_PENALTY
        self.shared = np.array(range(len(v.names)), dtype=object)  # one int object for each id, however many words hold it
        self.cache: dict[str, tuple[int, ...]] = {}
        self.most_cached = most_cached

    @staticmethod
    def _codes(text: str) -> np.ndarray:
        return mixed_bits(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1))

    def _hits(self, hashes: np.ndarray, codes: np.ndarray, many: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Places where a piece of `size` characters begins, and its number; `codes` are those of the characters, of which one word's are `many` apart."""
        at = self.first[(hashes >> np.uint64(44)).astype(np.int64)]
        rows = np.flatnonzero(at >= 0)
        at, sought = at[rows], hashes[rows]
        found = self.keys[at] == sought
        for _ in range(1, self.most_alike):
            again = np.flatnonzero(~found)
            if not len(again):
                break
            at[again] = np.minimum(at[again] + 1, len(self.keys) - 1)
            found[again] = self.keys[at[again]] == sought[again]
        rows, at = rows[found], at[found]
        same = self.sizes[at] == size
        for k in range(size):
            same &= codes[rows + k * many] == self.letters[at, k]
        return rows[same], at[same]

    def viterbi(self, words: list[str]) -> list[tuple[int, ...]]:
        """The best-scoring pieces of words that all have the same length; among equal sums, the shorter last piece."""
        n, many = len(words[0]), len(words)
        codes = np.ascontiguousarray(self._codes("".join(words)).reshape(many, n).T)
        # Matches of all substrings of a size at once, as flat places (start, word), which are in order of start.
        matches, running = [], codes
        for size in range(1, min(self.longest, n) + 1):
            if size > 1:
                running = running[:-1] * np.uint64(_BASE) + codes[size - 1 :]
            place, at = self._hits(running.ravel(), codes.ravel(), many, size)
            matches.append((place, at, np.searchsorted(place, np.arange(n - size + 2) * many)))
        best = np.zeros((n + 1, many))
        back = np.ones((n + 1, many), np.int32)
        ids = np.full((n + 1, many), -1, np.int32)
        for end in range(1, n + 1):
            best[end] = best[end - 1] + self.unknown_score
            for size in range(1, min(self.longest, end) + 1):
                place, at, cuts = matches[size - 1]
                low, high = cuts[end - size], cuts[end - size + 1]
                if low == high:
                    continue
                rows, at = place[low:high] - (end - size) * many, at[low:high]
                score = best[end - size, rows] + self.piece_scores[at]
                better = score > best[end, rows]
                rows, at = rows[better], at[better]
                best[end, rows] = score[better]
                back[end, rows] = size
                ids[end, rows] = self.piece_ids[at]
        return self._traced(words, back, ids)

    def _traced(self, words: list[str], back: np.ndarray, ids: np.ndarray) -> list[tuple[int, ...]]:
        """All words are walked back together; then their pieces are put in order of word and start."""
        rows, at, taken = np.arange(len(words)), np.full(len(words), len(back) - 1), []
        while len(rows):
            start = at - back[at, rows]
            taken.append((rows, start, ids[at, rows]))
            keep = start > 0
            rows, at = rows[keep], start[keep]
        rows, start, piece = (np.concatenate([t[k] for t in taken]) for k in range(3))
        order = np.lexsort((start, rows))
        rows, start, piece = rows[order], start[order], piece[order]
        ends = np.searchsorted(rows, np.arange(len(words) + 1)).tolist()
        unknown = set(rows[piece < 0].tolist())
        raw, piece = piece, self.shared[np.maximum(piece, 0)].tolist()
        out = []
        for r in range(len(words)):
            own = piece[ends[r] : ends[r + 1]]
            if r in unknown:
                own = [t for p, s in zip(raw[ends[r] : ends[r + 1]].tolist(), start[ends[r] : ends[r + 1]].tolist()) for t in ([p] if p >= 0 else self._bytes(words[r][s]))]
            out.append(tuple(own))
        return out

    def _bytes(self, character: str) -> list[int]:
        return self.v.byte_ids[list(MARK.encode() if character == _WRITTEN_MARK else character.encode())].tolist()

    def viterbi_in_blocks(self, words: list[str], block: int = 1 << 18) -> list[tuple[int, ...]]:
        """As `viterbi`, for words of any length: the same recurrence over blocks of positions.

        The matches of all sizes that end in a block are found at once; scores are held of the last `longest` positions only. What stays of
        every position is the size of its last piece, in a byte, and that piece.
        """
        n, many, most = len(words[0]), len(words), min(self.longest, len(words[0]))
        width = max(most, block // (most * many))
        back = np.ones((n + 1, many), np.min_scalar_type(most))
        ids = np.full((n + 1, many), -1, np.int32)
        best = np.full((most + width, many), -np.inf)  # row `most - 1` is the position before the block
        best[most - 1] = 0.0
        columns = np.arange(many)
        for low in range(0, n, width):
            high, first = min(n, low + width), max(0, low + 1 - most)
            gains = np.full((high - low, most, many), -np.inf)
            pieces = np.full((high - low, most, many), -1, np.int32)
            gains[:, 0] = self.unknown_score
            codes = np.ascontiguousarray(self._codes("".join(w[first:high] for w in words)).reshape(many, high - first).T)
            running = codes
            for size in range(1, min(most, high - first) + 1):
                if size > 1:
                    running = running[:-1] * np.uint64(_BASE) + codes[size - 1 :]
                skip = max(0, low + 1 - size - first)
                place, at = self._hits(running[skip:].ravel(), codes[skip:].ravel(), many, size)
                start, row = np.divmod(place, many)
                end = first + skip + start + size - low - 1
                gains[end, size - 1, row] = self.piece_scores[at]
                pieces[end, size - 1, row] = self.piece_ids[at]
            chosen = np.zeros((high - low, many), np.int64)
            for k in range(high - low):
                sums = best[k : k + most][::-1] + gains[k]
                chosen[k] = sums.argmax(0)  # the first of equal sums: the shorter last piece
                best[k + most] = sums[chosen[k], columns]
            back[low + 1 : high + 1] = chosen + 1
            ids[low + 1 : high + 1] = np.take_along_axis(pieces, chosen[:, None, :], 1)[:, 0]
            best[:most] = best[high - low : high - low + most].copy()
        return [self._walked(w, np.ascontiguousarray(back[:, r]), ids[:, r]) for r, w in enumerate(words)]

    def _walked(self, word: str, back: np.ndarray, ids: np.ndarray) -> tuple[int, ...]:
        """One long word walked back."""
        sizes, at, ends = memoryview(back), len(word), array("q")
        while at:
            ends.append(at)
            at -= sizes[at]
        ends = np.frombuffer(ends, np.int64)[::-1]
        own = self.shared[np.maximum(ids[ends], 0)].tolist()
        for k in np.flatnonzero(ids[ends] < 0).tolist():
            own[k] = self._bytes(word[ends[k] - 1])
        return tuple(chain.from_iterable(p if isinstance(p, list) else (p,) for p in own))

    def _learn(self, words: set[str], block: int = 1_000_000) -> None:
        by_length: dict[int, list[str]] = {}
        for w in words:
            by_length.setdefault(len(w), []).append(w)
        for same in by_length.values():
            marked = [w if w[:1] == MARK else MARK + w for w in same]
            for m in {len(w) for w in marked}:
                keys, full = zip(*((k, w) for k, w in zip(same, marked) if len(w) == m))
                solve = self.viterbi if m <= self.long else self.viterbi_in_blocks
                step = max(1, block // (m * 12))
                for k in range(0, len(full), step):
                    self.cache.update(zip(keys[k : k + step], solve(list(full[k : k + step]))))

    @staticmethod
    def _words(text: str) -> list[str]:
        """The words of a text after a space has been put before it. One led by a single mark is given without it, others with all their marks; a trailing run of marks is a word too."""
        parts = text.replace(MARK, _WRITTEN_MARK).split(" ")
        if "" not in parts:
            return parts
        out, marks = [], 0
        for p in parts:
            marks += 1
            if p:
                out.append(p if marks == 1 else MARK * marks + p)
                marks = 0
        if marks:
            out.append(MARK * marks)
        return out

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Token ids of each text; a null or empty text has none."""
        cut = [self._words(t) if t else [] for t in texts]
        if len(self.cache) > self.most_cached:
            self.cache.clear()
        new = set().union(*cut).difference(self.cache)
        self._learn(new)
        out = [list(chain.from_iterable(map(self.cache.__getitem__, words))) for words in cut]
        for w in new:
            if len(w) > self.long:
                del self.cache[w]
        return out


class Decoder:
    def __init__(self, vocabulary: Vocabulary):
        self.bytes = [n.replace(MARK, " ").encode() for n in vocabulary.names]
        for b, k in enumerate(vocabulary.byte_ids):
            self.bytes[k] = bytes([b])

    def decode(self, ids) -> str:
        """The text of token ids; the space that encoding put before the text is taken off again."""
        raw = b"".join(map(self.bytes.__getitem__, ids))
        return raw.decode("utf-8", "replace")[1:] if raw[:1] == b" " else raw.decode("utf-8", "replace")


def encode(docs: DataFrame, vocabulary: Vocabulary, chunk_bytes: int = 1 << 20) -> DataFrame:
    """(doc_id, n_tokens, tokens array<int>, exact) for each row of `docs` (doc_id, text; other columns are ignored).

    Pieces are those of the greatest summed score; a character that no piece covers becomes its UTF-8 bytes. exact:
    decoding the tokens gives the text back. A null text has null tokens (n_tokens 0, exact null), an empty one no tokens.
    Repeated rows are each encoded; an empty table gives an empty result.
    """
    schema = "doc_id long, n_tokens long, tokens array<int>, exact boolean"

    def run(batches):
        encoder, decoder = Encoder(vocabulary), Decoder(vocabulary)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            first, size, part = 0, 0, []
            for k, value in enumerate(texts):
                part.append(value.as_py())
                size += len(part[-1] or "")
                if size < chunk_bytes and k + 1 < len(texts):
                    continue
                tokens = encoder.encode(part)
                ends = np.cumsum([0, *map(len, tokens)])
                nulls = pa.array([t is None for t in part])
                exact = [None if t is None else decoder.decode(x) == t for t, x in zip(part, tokens)]
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.fromiter(chain.from_iterable(tokens), np.int32, int(ends[-1]))), mask=nulls)
                yield pa.RecordBatch.from_arrays([ids.slice(first, len(part)), pa.array(np.diff(ends), pa.int64()), lists, pa.array(exact, pa.bool_())], names=["doc_id", "n_tokens", "tokens", "exact"])
                first, size, part = k + 1, 0, []

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(released(run), schema)


def decode(tokens: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """`tokens` (tokens array<int>, ...) with a `text` column; null tokens give a null text."""
    tokens = tokens.drop("text")
    at = tokens.columns.index("tokens")

    def run(batches):
        decoder = Decoder(vocabulary)
        for batch in batches:
            texts = [None if t is None else decoder.decode(t) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "text"])

    return tokens.mapInArrow(run, T.StructType([*tokens.schema.fields, T.StructField("text", T.StringType())]))
