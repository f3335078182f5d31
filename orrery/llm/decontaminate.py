"""Benchmark decontamination with suffix arrays of the training texts.

Each batch of documents is a shard. Its suffix array holds the word positions
whose words all occur in the benchmark for at least the shortest window's
length (no other suffix can match one), sorted by rank doubling. Every suffix
of every benchmark item is then searched in it by bisection, one word deeper at
a time, until its interval is empty: that gives its longest verbatim match and
where it lies, and on the way the interval of its window.

The benchmark lies in the shared folder in blocks of bounded size, and a task
reads one block after the other, so neither the driver nor a task holds it
whole.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.llm import bytehash
from orrery.llm.common import aside, back, batches, kept, mapped, open_fs, text_bytes
from orrery.session import stage_path

BLOCK_BYTES = 4 << 20
FOLD = bytehash.lower_table()
MEMBER = np.zeros(256, bool)  # digits, letters and every byte of a character beyond ASCII
MEMBER[0x30:0x3A] = MEMBER[0x61:0x7B] = MEMBER[0x80:] = True


def word_runs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in a row, and where each text's begin."""
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    ends = np.cumsum(sizes)
    lo, _, h = bytehash.words(np.frombuffer(b"\n".join(texts) + b"\n", np.uint8), FOLD, MEMBER)
    return h, np.searchsorted(lo, np.r_[0, ends])


@dataclass
class Block:
    """Benchmark items as word ids (from 1), one after the other."""

    vocabulary: np.ndarray  # sorted word hashes; id = place + 1
    ids: np.ndarray
    item: np.ndarray  # item of each word
    left: np.ndarray  # words from here to the item's end
    first: np.ndarray  # whether the item begins here
    names: list[str]
    window: int

    @classmethod
    def of(cls, names: list[str], texts: list[bytes], window: int) -> Block:
        h, bounds = word_runs(texts)
        n = np.diff(bounds)
        vocabulary, ids = np.unique(h, return_inverse=True)
        item = np.repeat(np.arange(len(texts)), n)
        left = bounds[1:][item] - np.arange(len(h))
        return cls(vocabulary, ids.astype(np.int64) + 1, item, left, left == n[item], names, window)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Places where a window begins, and its length there."""
        at = np.flatnonzero((self.left >= self.window) | self.first)
        return at, np.minimum(self.left[at], self.window)


class SuffixArray:
    """Suffixes of word ids ``ids`` (0: a word that no item has) that start in
    a run of at least ``least`` words without 0."""

    def __init__(self, ids: np.ndarray, least: int, depth: int):
        edge = np.flatnonzero(np.diff(np.r_[False, ids > 0, False].view(np.int8)))
        lo, hi = edge[::2], edge[1::2]
        long = hi - lo >= least
        lo, n = lo[long], (hi - lo)[long]
        # the runs in a row, each followed by a 0
        self.n = int((n + 1).sum())
        run_at = np.cumsum(n + 1) - (n + 1)
        self.place = np.arange(self.n) + np.repeat(lo - run_at, n + 1)
        self.word = np.r_[ids, 0][self.place]
        self.word[run_at + n] = 0
        rank, h = self.word.copy(), 1
        while h < depth and self.n:
            nxt = np.zeros_like(rank)
            nxt[:-h or None] = rank[h:] if h < self.n else 0
            # a suffix that has ended stays where it is
            pair = rank * (self.n + int(self.word.max()) + 1) + np.where(rank > 0, nxt, 0)
            new = np.unique(pair, return_inverse=True)[1]
            new = np.where(self.word > 0, new + 1, 0)
            h *= 2
            if new.max(initial=0) == rank.max(initial=0) and h > 2:
                rank = new
                break
            rank = new
        order = np.argsort(rank, kind="stable")
        self.order = order[self.word[order] > 0]
        self.word = np.r_[self.word, 0]

    def at(self, places: np.ndarray, depth: int) -> np.ndarray:
        """The word ``depth`` after the suffixes at these places of the array."""
        return self.word[np.minimum(self.order[places] + depth, self.n)]

    def _bisect(self, lo, hi, depth, word, right):
        lo, hi = lo.copy(), hi.copy()
        open_ = lo < hi
        while open_.any():
            k = np.flatnonzero(open_)
            mid = (lo[k] + hi[k]) // 2
            w = self.at(mid, depth)
            up = w <= word[k] if right else w < word[k]
            lo[k[up]] = mid[up] + 1
            hi[k[~up]] = mid[~up]
            open_ = lo < hi
        return lo

    def search(self, block: Block):
        """For each suffix of the block: length and a place of its longest
        match, and for each window the interval of its occurrences."""
        m = len(block.ids)
        lo, hi = np.zeros(m, np.int64), np.full(m, len(self.order), np.int64)
        longest, where = np.zeros(m, np.int64), np.full(m, -1, np.int64)
        w_at, w_len = block.windows()
        need = np.zeros(m, np.int64)
        need[w_at] = w_len
        w_lo, w_hi = np.zeros(m, np.int64), np.zeros(m, np.int64)
        live, depth = np.arange(m), 0
        while len(live) and len(self.order):
            word = block.ids[live + depth]
            a = self._bisect(lo[live], hi[live], depth, word, False)
            b = self._bisect(a, hi[live], depth, word, True)
            lo[live], hi[live] = a, b
            depth += 1
            live = live[a < b]
            longest[live] = depth
            where[live] = self.order[lo[live]]
            done = live[need[live] == depth]
            w_lo[done], w_hi[done] = lo[done], hi[done]
            live = live[block.left[live] > depth]
        return longest, where, w_at, w_lo[w_at], w_hi[w_at], w_len


_BLOCKS: dict[tuple, Block] = kept(__name__, {})


def _block(uri: str, window: int) -> Block:
    """A block of the shared folder; the last one read stays in the worker."""
    if (uri, window) not in _BLOCKS:
        _BLOCKS.clear()
        fs, path = open_fs(uri)
        t = pq.read_table(path, filesystem=fs)
        _BLOCKS[uri, window] = Block.of(t["item"].to_pylist(), text_bytes(t["text"].combine_chunks()), window)
    return _BLOCKS[uri, window]


def put_items(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> list[str]:
    """Write the benchmark in blocks to the shared folder; returns the files."""
    spark = items.sparkSession
    src = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = src.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    path = stage_path(spark, "benchmark")
    src.repartition(1 + size // BLOCK_BYTES, F.xxhash64("item", "text")).write.parquet(path)
    return sorted(spark.read.schema(src.schema).parquet(path).inputFiles())


FOUND = T.ArrayType(T.StructType().add("item", "string").add("item_word", "long").add("doc_word", "long")
                    .add("words", "long"))
ADDED = (T.StructType().add("n_words", "long").add("n_hit", "long").add("items", T.ArrayType(T.StringType()))
         .add("matches", FOUND))
_ARROW_FOUND = pa.list_(pa.struct([("item", pa.string()), ("item_word", pa.int64()), ("doc_word", pa.int64()),
                                   ("words", pa.int64())]))


def _extend(block: Block, ids: np.ndarray, bounds: np.ndarray, j: int, p: int) -> int:
    """Words that the item's suffix at j and the documents' word p share; ends
    with the item and the document."""
    stop = bounds[np.searchsorted(bounds, p, "right")]
    n = int(min(block.left[j], stop - p))
    differ = np.flatnonzero(block.ids[j:j + n] != ids[p:p + n])
    return int(differ[0]) if len(differ) else n


def inspect(docs: DataFrame, items: DataFrame, window: int = 10, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, n_hit (words inside any occurrence of a window of
    an item), items (ids of the items with occurring windows, sorted as
    strings) and matches (item, word of the item, word of the document and
    length of each longest match that begins with a window and continues none
    further left).

    A window is ``window`` consecutive words of an item; an item of fewer, but
    not none, is one window. Words are runs of digits, letters a-z and
    characters beyond ASCII, A-Z lower-cased. Null and empty texts have no
    words; items without words match nothing; rows of equal item id count
    once; a null item id reads ``null``. Other columns of ``docs`` stay;
    existing columns of the new names are replaced. Words are compared by
    64-bit hashes."""
    files = put_items(items)
    src = docs.drop(*ADDED.names)
    at = src.columns.index(text_col)
    schema = T.StructType([*src.schema.fields, *ADDED.fields])

    def run(it):
        for b in batches(it, 4 << 20, text_col):
            h, bounds = word_runs(text_bytes(b.column(at)))
            n = len(bounds) - 1
            # one more word after each document, which no item has
            doc = np.repeat(np.arange(n), np.diff(bounds))
            spread, edges = np.arange(len(h)) + doc, bounds + np.arange(n + 1)
            hit = np.zeros(len(h) + n + 1, np.int32)
            names: list[set] = [set() for _ in range(n)]
            found: list[list] = [[] for _ in range(n)]
            for uri in files:
                block = _block(uri, window)
                if not len(block.ids) or not len(h):
                    continue
                k = np.minimum(np.searchsorted(block.vocabulary, h), len(block.vocabulary) - 1)
                ids = np.zeros(len(h) + n, np.int64)
                ids[spread] = np.where(block.vocabulary[k] == h, k + 1, 0)
                sa = SuffixArray(ids, int(block.windows()[1].min()), int(block.left.max()))
                _, _, w_at, lo, hi, w_len = sa.search(block)
                some = np.flatnonzero(hi > lo)
                count = hi[some] - lo[some]
                if not len(count):
                    continue
                js, size = np.repeat(w_at[some], count), np.repeat(w_len[some], count)
                pick = np.arange(count.sum()) + np.repeat(lo[some] - (np.cumsum(count) - count), count)
                ps = sa.place[sa.order[pick]]
                np.add.at(hit, ps, 1)
                np.add.at(hit, ps + size, -1)
                ds = np.searchsorted(edges, ps, "right") - 1
                pairs = np.unique(np.stack([ds, block.item[js]]), axis=1)
                for d, i in pairs.T.tolist():
                    names[d].add(block.names[i])
                # occurrences whose words before them match too are parts of longer ones
                left = (~block.first[js]) & (ps > 0) & (block.ids[js - 1] == ids[ps - 1])
                for j, p, d in zip(js[~left].tolist(), ps[~left].tolist(), ds[~left].tolist()):
                    i = int(block.item[j])
                    found[d].append({"item": block.names[i],
                                     "item_word": j - int(np.searchsorted(block.item, i)),
                                     "doc_word": p - int(edges[d]), "words": _extend(block, ids, edges, j, p)})
            covered = np.r_[0, np.cumsum(np.cumsum(hit)[:-1] > 0)]
            n_hit = covered[edges[1:]] - covered[edges[:-1]]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.diff(bounds), pa.int64()), pa.array(n_hit, pa.int64()),
                 pa.array([sorted(s) for s in names], pa.list_(pa.string())), pa.array(found, _ARROW_FOUND)],
                names=[*b.schema.names, *ADDED.names])

    return src.transform(mapped, run, schema)


def clean(docs: DataFrame, items: DataFrame, window: int = 10, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no window of an item occurs; columns as in
    ``docs``, whatever their names."""
    hidden, names = aside(docs, ADDED.names)
    return back(inspect(hidden, items, window, names.get(text_col, text_col)).where("n_hit = 0"), docs, names)


def digest(names: list[str]) -> str:
    return hashlib.sha256(",".join(names).encode()).hexdigest()
