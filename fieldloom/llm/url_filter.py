"""URL filters: all glob rules in one bit-parallel Shift-And automaton over several machine words."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Stands between host and path of a canonical URL; neither can hold it.
MARK = 0
_ANY, _IN_PART = "*", "?"


@dataclass(frozen=True)
class HostRule:
    """A verdict for a host with all its subdomains, below a path."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class GlobRule:
    """A verdict for canonical URLs `host` + path (with query) that a glob fits: `*` any run, `?` one character."""

    verdict: str
    glob: str


def _literal(text: str) -> list[tuple]:
    return [("byte", b) for b in text.encode()]


def _host_patterns(rule: HostRule) -> list[list[tuple]]:
    """The host itself, and anything but the mark before a dot and the host; then the mark, the path and the rest."""
    end = _literal(rule.host) + [("byte", MARK)] + _literal(rule.path) + [("loop", None)]
    return [end, [("loop", MARK), *_literal("." + rule.host), *end[len(rule.host.encode()) :]]]


def _glob_pattern(rule: GlobRule) -> list[tuple]:
    """A glob sees host and path as one string; the mark is an empty step between them, so it may be stepped over anywhere."""
    out: list[tuple] = []
    for piece in rule.glob:
        out += [("loop", None)] if piece == _ANY else [("one", None)] if piece == _IN_PART else _literal(piece)
    return out


class ShiftAnd:
    """A nondeterministic automaton with a bit for each pattern position, run over a matrix of texts a column at a time.

    Bit j of a pattern says that its first j items are consumed. A loop item keeps its own bit alive on the bytes it
    accepts and lets the next bit start without consuming anything.
    """

    def __init__(self, patterns: list[list[tuple]], skip_mark: list[bool]):
        bits = sum(sum(kind != "loop" for kind, _ in p) + 1 for p in patterns)
        self.words = (bits + 63) // 64
        self.take = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        self.final = np.zeros((len(patterns), 2), np.int64)
        at = 0
        for k, pattern in enumerate(patterns):
            self._put(self.start, at)
            if skip_mark[k]:
                for j in range(sum(kind != "loop" for kind, _ in pattern) + 1):
                    self._put(self.stay[MARK], at + j)
            for kind, value in pattern:
                if kind == "loop":
                    for byte in range(256):
                        if byte != value:
                            self._put(self.stay[byte], at)
                    continue
                at += 1
                for byte in [value] if kind == "byte" else [b for b in range(256) if b != MARK]:
                    self._put(self.take[byte], at)
            self.final[k] = divmod(at, 64)
            at += 1

    @staticmethod
    def _put(mask: np.ndarray, bit: int) -> None:
        mask[bit // 64] |= np.uint64(1) << np.uint64(bit % 64)

    def run(self, texts: list[bytes]) -> np.ndarray:
        """(texts, patterns) of bool: whether the whole text is matched. Texts are stepped together, shorter ones drop out."""
        order = np.argsort([len(t) for t in texts], kind="stable")[::-1]
        lengths = np.array([len(texts[k]) for k in order], np.int64)
        states = np.tile(self.start, (len(texts), 1))
        ends = np.concatenate(([0], np.cumsum(lengths)))
        data = np.frombuffer(b"".join(texts[k] for k in order), np.uint8)
        one, top = np.uint64(1), np.uint64(63)
        for at in range(int(lengths[0]) if len(lengths) else 0):
            live = int(np.searchsorted(-lengths, -at, side="left"))
            byte = data[ends[:live] + at]
            now = states[:live]
            shifted = now << one
            if self.words > 1:
                shifted[:, 1:] |= now[:, :-1] >> top
            states[:live] = (shifted & self.take[byte]) | (now & self.stay[byte])
        hit = np.empty((len(texts), len(self.final)), bool)
        for k, (word, bit) in enumerate(self.final):
            hit[order, k] = (states[:, word] >> np.uint64(bit)) & one
        return hit


class UrlRules:
    """Host rules, of which the longest that fits decides, and globs for all other URLs: any blocking glob blocks, else allow."""

    def __init__(self, host_rules: list[HostRule], globs: list[GlobRule]):
        self.host_rules, self.globs = host_rules, globs
        patterns = [p for r in host_rules for p in _host_patterns(r)]
        self.automaton = ShiftAnd(patterns + [_glob_pattern(g) for g in globs], [False] * len(patterns) + [True] * len(globs))

    def judge(self, urls: list[bytes]) -> tuple[list[str | None], list[str]]:
        hit = self.automaton.run(urls)
        n = 2 * len(self.host_rules)
        fits = hit[:, 0:n:2] | hit[:, 1:n:2]
        size = np.array([len(r.name) for r in self.host_rules], np.int64)
        best = np.where(fits, size, -1).argmax(axis=1) if len(size) else np.zeros(len(urls), np.int64)
        found = fits.any(axis=1)
        blocks = hit[:, n:][:, [g.verdict == "block" for g in self.globs]].any(axis=1)
        allows = hit[:, n:][:, [g.verdict == "allow" for g in self.globs]].any(axis=1)
        rules = [self.host_rules[b].name if f else None for b, f in zip(best, found)]
        verdicts = [self.host_rules[b].verdict if f else "block" if x and not y else "allow" for b, f, x, y in zip(best, found, blocks, allows)]
        return rules, verdicts


def url_verdicts(pages: DataFrame, host_rules: list[HostRule], globs: list[GlobRule], chunk: int = 20_000) -> DataFrame:
    """(page_id, host, path, rule, verdict) for each row of `pages` (page_id, url; other columns are ignored).

    The host is what follows the first `://` up to `/`, `?`, `#` or the end, lower-cased in A-Z; the path goes on up to
    `?`, `#` or the end. A null url or one without `://` has an empty host and path and is judged as an empty canonical
    URL. Globs see host, path and query without the fragment. Among fitting globs, allow outweighs block. The largest
    state is texts x (bits of all rules / 64) words; a very long URL costs a step for each of its bytes. Repeated rows
    are each returned; an empty table gives an empty result.
    """
    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    after = F.regexp_extract(rest, r"^[^/?#]*([^#]*)", 1)
    ready = pages.select("page_id", F.coalesce(host, F.lit("")).alias("host"), F.coalesce(after, F.lit("")).alias("after"))
    ready = ready.select("page_id", "host", F.regexp_extract("after", r"^([^?]*)", 1).alias("path"), F.col("after"))

    def run(batches):
        rules = UrlRules(host_rules, globs)
        for batch in batches:
            for k in range(0, batch.num_rows, chunk):
                part = batch.slice(k, chunk)
                hosts, rests = (part.column(c).cast(pa.binary()).to_pylist() for c in (1, 3))
                urls = [h.replace(b"\0", b"\1") + b"\0" + r.replace(b"\0", b"\1") for h, r in zip(hosts, rests)]
                names, verdicts = rules.judge(urls)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array(names, pa.string()), pa.array(verdicts, pa.string())], names=["page_id", "host", "path", "rule", "verdict"])

    return ready.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")


#: Globs for URLs that no host rule covers: downloads, log-ins and click counters.
DEFAULT_GLOBS = [
    GlobRule("block", "ads.*"),
    GlobRule("block", "*/ads/*"),
    GlobRule("block", "*/login*"),
    GlobRule("block", "*/wp-admin/*"),
    GlobRule("block", "*.zip"),
    GlobRule("block", "*.exe"),
    GlobRule("block", "*utm_*=*"),
    GlobRule("block", "*sessionid=*"),
]
