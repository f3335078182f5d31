"""Runs of repeated word sequences, found online by catchers over dyadic blocks.

At level b (a power of two) every completed block of b words at a multiple of
b is a catcher for the b word positions after it: each appended word completes
a suffix of length b, which is compared with the block of the one catcher that
waits for it. An equal suffix at distance q, b <= q < 2b, is a piece of a
stretch of period q. It is extended to both sides; a stretch that reaches the
last word goes on with the words appended next. Stretches that hold the squares
asked for merge into runs by their start and period. A word makes one
comparison a level, so n words cost n log n comparisons.

A stretch of three or more periods q holds an aligned block of q's level and
its copy at distance q, so none is missed. Windows are compared by prefix sums
modulo a prime, which never part equal windows; every run that is kept has
been compared word for word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orrery.llm.common import batches, mapped, text_bytes

PIECE = 1 << 17  # words appended at once, and about so many of short texts together
CUT = 1 << 20  # bytes of text split at once
PRIME = np.uint64(2**31 - 1)
BASE = 1_103_515_245
_BLANKS = b" \t\n\x0b\x0c\r"


class Catchers:
    """Runs of a growing sequence of word numbers: stretches of smallest period
    q, of ``least`` and of ``exponent`` * q words or more, that no neighbouring
    word extends. ``exponent`` is 3 or more."""

    def __init__(self, least: int = 6, exponent: int = 4):
        if exponent < 3:
            raise ValueError("a stretch of fewer than three periods may hold no block with its copy")
        self.least, self.exponent, self.n = least, exponent, 0
        self._words, self._sums = np.zeros(0, np.int64), np.zeros(1, np.uint64)
        self._powers = np.ones(1, np.uint64)
        self._next: list[int] = []  # of level k: the next suffix to compare
        self._open: list[np.ndarray] = []  # of level k: (block, period) of stretches that reach the last word
        self._found = np.zeros((0, 3), np.int64)  # start, end, period

    def append(self, numbers: np.ndarray, span: int) -> None:
        """Append word numbers. ``span``: the length of the longest text so
        far, which no stretch passes."""
        old, n = self.n, self.n + len(numbers)
        if n > len(self._words):
            more = max(n, 2 * len(self._words)) - old
            self._words = np.r_[self._words[:old], np.zeros(more, np.int64)]
            self._sums = np.r_[self._sums[:old + 1], np.zeros(more, np.uint64)]
        while len(self._powers) <= n:
            step = np.uint64(pow(BASE, len(self._powers), int(PRIME)))
            self._powers = np.r_[self._powers, self._powers * step % PRIME]
        self._words[old:n] = numbers
        value = (numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % PRIME
        self._sums[old + 1:n + 1] = self._sums[old] + np.cumsum(value * self._powers[old:n] % PRIME, dtype=np.uint64)
        self.n = n
        k = 0
        while self.exponent << k <= span:
            if k == len(self._next):
                self._next.append(1 << k)
                self._open.append(np.zeros((0, 2), np.int64))
            self._settle(k, np.r_[self._open[k], self._hits(k)])
            k += 1
        for k in range(k, len(self._next)):  # no longer text: the level's stretches have ended
            self._open[k] = self._open[k][:0]

    def runs(self) -> np.ndarray:
        """(start, end, period) of the runs so far, by start and period."""
        rows = self._found
        # of one start and period the longest, of one stretch the smallest period
        for key, best in (((0, 2), -1), ((0, 1), 2)):
            order = np.lexsort((rows[:, 2] if best == 2 else -rows[:, 1], rows[:, key[1]], rows[:, key[0]]))
            rows = rows[order]
            if len(rows):
                rows = rows[np.r_[True, np.any(rows[1:, key] != rows[:-1, key], axis=1)]]
        return rows[np.lexsort((rows[:, 2], rows[:, 0]))]

    def _hits(self, k: int) -> np.ndarray:
        """(block, period) where a new suffix of level k equals its catcher's block."""
        b, lo = 1 << k, self._next[k]
        hi = max(lo, self.n - b + 1)
        self._next[k] = hi
        at = np.arange(lo, hi)
        block = (at >> k << k) - b
        first = self._words[block] == self._words[at]
        at, block = at[first], block[first]
        same = self._same(block, at, b)
        at, block = at[same], block[same]
        # what lies in a run of a period below b has no other smallest period at this level
        inner = self._found[self._found[:, 2] < b]
        if len(at) and len(inner):
            inner = inner[np.argsort(inner[:, 0], kind="stable")]
            reach = np.maximum.accumulate(inner[:, 1])
            i = np.searchsorted(inner[:, 0], block, "right") - 1
            free = (i < 0) | (reach[i] < at + b)
            at, block = at[free], block[free]
        return np.c_[block, at - block]

    def _settle(self, k: int, rows: np.ndarray) -> None:
        """Extend (block, period) of level k; keep runs, and what reaches the last word."""
        block, q = rows[:, 0], rows[:, 1]
        left, right = self._extent(block, block + q, -1), self._extent(block, block + q, 1)
        all_ = np.c_[block - left, block + q + right, q, block]
        all_ = all_[np.unique(all_[:, [0, 2]], axis=0, return_index=True)[1]] if len(all_) else all_
        long = all_[:, 1] - all_[:, 0] >= np.maximum(self.least, self.exponent * all_[:, 2])
        runs = []
        for start, end, period, at in all_[long].tolist():
            start, end = self._checked(start, end, period, at, 1 << k)
            if end - start >= max(self.least, self.exponent * period):
                runs.append((start, end, period))
        self._found = np.r_[self._found, np.array(runs, np.int64).reshape(-1, 3)]
        self._open[k] = all_[all_[:, 1] == self.n][:, [3, 2]]

    def _same(self, i: np.ndarray, j: np.ndarray, size: int) -> np.ndarray:
        """Whether the windows of ``size`` words at i < j have equal sums."""
        a = (self._sums[i + size] - self._sums[i]) % PRIME * self._powers[j - i] % PRIME
        return a == (self._sums[j + size] - self._sums[j]) % PRIME

    def _extent(self, i: np.ndarray, j: np.ndarray, way: int) -> np.ndarray:
        """How many words from i and j on (way 1) or before them (way -1) are equal, i < j."""
        got = np.zeros(len(i), np.int64)
        room = self.n - j if way > 0 else i
        size = 1 << int(room.max(initial=0)).bit_length()
        while size := size >> 1:
            ok = np.flatnonzero(got + size <= room)
            shift = got[ok] if way > 0 else -got[ok] - size
            ok = ok[self._same(i[ok] + shift, j[ok] + shift, size)]
            got[ok] += size
        return got

    def _checked(self, start: int, end: int, q: int, block: int, b: int) -> tuple[int, int]:
        """The part around ``block`` that has period q word for word; (0, 0)
        where the block and its copy differ."""
        off = np.flatnonzero(self._words[start:end - q] != self._words[start + q:end]) + start
        if len(off) == 0:
            return start, end
        i = np.searchsorted(off, block)
        j = np.searchsorted(off, block + b)
        if i < j:
            return 0, 0
        return int(off[i - 1]) + 1 if i else start, int(off[j]) + q if j < len(off) else end


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some at a time; a piece ends at a blank."""
    at = 0
    while at < len(text):
        end = min(len(text), at + CUT)
        while end < len(text) and text[end] not in _BLANKS:
            end += 1
        yield text[at:end].split()
        at = end


def _numbered(text: bytes, names: dict[bytes, int]) -> np.ndarray:
    parts = [np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words))
             for words in _pieces(text)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _dropped(n: int, runs: np.ndarray) -> np.ndarray:
    """Of n words, those that a run contains after its first period."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, runs[:, 0] + runs[:, 2], 1)
    np.add.at(step, runs[:, 1], -1)
    return np.cumsum(step)[:n] > 0


def _streams(texts: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Ranges of texts that share catchers: short texts together, a long one alone."""
    lo = size = 0
    for k, t in enumerate(texts):
        if size and size + len(t) > PIECE:
            yield lo, k
            lo, size = k, 0
        size += len(t) + 1
    if lo < len(texts):
        yield lo, len(texts)


def find(texts: list[np.ndarray], least: int = 6, exponent: int = 4) -> list[np.ndarray]:
    """The runs of each sequence of word numbers: (start, end, period) by start
    and period. Sequences follow one another between marks that equal nothing."""
    out: list[np.ndarray] = []
    for lo, hi in _streams(texts):
        catchers, starts, at = Catchers(least, exponent), [], 0
        flat = []
        for k in range(lo, hi):
            starts.append(at)
            flat += [texts[k], np.array([-1 - k], np.int64)]
            at += len(texts[k]) + 1
        flat = np.concatenate(flat)
        longest = max(len(t) for t in texts[lo:hi])
        for i in range(0, len(flat), PIECE):
            catchers.append(flat[i:i + PIECE], min(longest, i + PIECE))
        runs = catchers.runs()
        cut = np.searchsorted(runs[:, 0], [*starts, at])
        out += [runs[a:b] - np.array([s, s, 0]) for a, b, s in zip(cut, cut[1:], starts)]
    return out


def runs(docs: DataFrame, least: int = 6, exponent: int = 4, id_col: str = "doc_id", text_col: str = "text",
         order: Callable[[object, int], np.ndarray | None] | None = None) -> DataFrame:
    """One row per row of ``docs``: id, n_words, ``runs`` (array of start,
    length, period by start and period; words count from 0) and ``collapsed``
    (UTF-8 of the words that no run repeats, joined by one space).

    A run is a stretch of words of smallest period q, of max(least, exponent *
    q) words or more, that no neighbouring word extends with that period; its
    words after the first q are left out of ``collapsed``. Words are split at
    blanks \\x20 and \\x09-\\x0D. ``order(id, n)`` may give the places from which
    the n words of a text are read in place of 0 to n - 1.

    Null, empty and blank texts have no words and no runs. Rows of equal id or
    text are handled each for itself, null ids too; other columns aren't read.
    An empty table gives an empty one."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    more = StructType.fromDDL("n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary")
    schema = StructType([src.schema["id"], *more])

    def run(it):
        for b in batches(it, 4 * CUT, "text"):
            names: dict[bytes, int] = {}
            texts = [_numbered(t, names) for t in text_bytes(b.column(1))]
            if order is not None:
                for k, i in enumerate(b.column(0).to_pylist()):
                    if (places := order(i, len(texts[k]))) is not None:
                        texts[k] = texts[k][places]
            words = list(names)
            found = find(texts, least, exponent)
            left = [t if len(r) == 0 else t[~_dropped(len(t), r)] for t, r in zip(texts, found)]
            bodies = [b" ".join([words[i] for i in t.tolist()]) for t in left]
            rows = np.concatenate(found)
            offsets = pa.array(np.r_[0, np.cumsum([len(r) for r in found])], pa.int32())
            items = pa.StructArray.from_arrays(
                [pa.array(rows[:, 0]), pa.array(rows[:, 1] - rows[:, 0]), pa.array(rows[:, 2])],
                names=["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t) for t in texts], pa.int64()),
                 pa.ListArray.from_arrays(offsets, items), pa.array(bodies, pa.binary())],
                names=["id", "n_words", "runs", "collapsed"])

    return src.transform(mapped, run, schema).withColumnRenamed("id", id_col)


def digests(found: DataFrame) -> DataFrame:
    """The other columns of ``runs`` with: n_runs; start, length, period and
    exponent_milli = floor(1000 length / period) of the run of the greatest
    exact length / period (ties: smallest start, then period; nulls without a
    run); SHA-256 of all runs as ``start,length,period`` lines and of the
    collapsed text."""
    # lengths and periods below 2^31: products are exact
    best = F.expr("""aggregate(runs, CAST(NULL AS STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>),
        (a, r) -> IF(a IS NULL OR r.length * a.period > a.length * r.period, r, a))""")
    lines = F.expr("concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')))")
    rest = [c for c in found.columns if c not in ("runs", "collapsed", "n_words")]
    return (found.withColumns({"best": best, "n_runs": F.size("runs").cast("long"), "runs_sha256": F.sha2(lines, 256),
                               "collapsed_sha256": F.sha2("collapsed", 256)})
            .select(*rest, "n_runs", "best.start", "best.length", "best.period",
                    F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
                    "runs_sha256", "collapsed_sha256", "n_words"))
