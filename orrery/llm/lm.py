"""Language-model scoring with an Elias-Fano n-gram trie.

Level one holds the words (64-bit hashes) in shards by hash range; a word's id
is its place over all shards, and its count is the step between two sums. Each
further level holds the successors of the level before: the words that follow a
word (level two) or a pair (level three), context after context, in shards by
context. A pointer sequence over the level before, cut into the same shards,
says where the successors of each context begin, so a word is searched between
two pointers. Successor ids restart at every context; to make one increasing
sequence of them, each context's begin at the last number of the one before. A
pair's id is its place in level two, and that is its context in level three.

Sequences are Elias-Fano coded. Beside the successors stand the quantised share
of each n-gram and, where another level follows, what smoothing leaves to the
level below. Scoring tasks map the files of the shared folder and search them
in place.

P(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)), and after a context u of one or more
words, of which u' are all but the first,
P(w | u) = (c(u, w) + m P(w | u')) / (c(u) + m) with m = c(u) ** power.

A context with very many tokens has a shard for each range of its successors.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.llm import bytehash, eliasfano
from orrery.llm.common import batches, kept, make_dir, mapped, open_fs, open_mapped, release, text_bytes

FOLD = bytehash.lower_table()
MEMBER = np.ones(256, bool)
MEMBER[[0x20, 9, 10, 11, 12, 13]] = False
END = np.uint64(0x5EED0FE0D)  # stands for the end of a text
GROUP = 8 << 20  # bytes of text that are counted or scored at once
SHARD_TOKENS = 1 << 20  # training tokens for each shard of successors
CODES = 4096  # quantisation steps in a power of ten
OPEN = 256  # mapped shards that a Python worker keeps
SHARE = 10.0 ** (np.arange(1 << 16) / -CODES)


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words with an end after each text, and where each text's
    tokens begin."""
    ends = np.cumsum([len(t) + 1 for t in texts])
    lo, _, h = bytehash.words(np.frombuffer(b" ".join(texts) + b" ", np.uint8), FOLD, MEMBER)
    cut = np.searchsorted(lo, np.r_[0, ends])
    bounds = cut + np.arange(len(cut))
    out = np.full(bounds[-1], END, np.uint64)
    out[np.arange(len(h)) + np.repeat(np.arange(len(texts)), np.diff(cut))] = h
    return out, bounds


def _groups(it, column):
    """Arrow batches joined up to GROUP bytes of text."""
    held, size = [], 0
    for b in batches(it, GROUP // 4, column):
        n = b.column(b.schema.get_field_index(column)).nbytes
        if held and size + n > GROUP:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
        held.append(b)
        size += n
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else counts[:0]


def _put(uri: str, data: bytes) -> None:
    """Write a file whose content depends on its name alone: whole, or not at
    all, however often a task is run."""
    fs, path = open_fs(uri)
    if fs.get_file_info(path).type != pafs.FileType.NotFound:
        return
    part = f"{path}.{uuid.uuid4().hex}"
    with fs.open_output_stream(part, compression=None) as f:
        f.write(data)
    fs.move(part, path)


def _code(p: np.ndarray) -> bytes:
    return np.clip(np.rint(-np.log10(p) * CODES), 0, 65535).astype(np.uint16).tobytes()


@dataclass
class Shards:
    """How the successors of a level are dealt into files."""

    name: str
    starts: np.ndarray  # first context of each shard, and the number of contexts
    hot: np.ndarray  # contexts with shards of their own, ascending
    hot_count: np.ndarray  # training tokens after each
    hot_first: np.ndarray  # number of the first shard
    hot_parts: np.ndarray  # how many
    last: bool  # no level follows
    before: np.ndarray | None = None  # successors before each shard

    @classmethod
    def of(cls, name: str, starts: np.ndarray, hot: list[tuple[int, int]], shard_tokens: int, last: bool):
        count = np.array([c for _, c in hot], np.int64)
        parts = 2 + 2 * count // shard_tokens
        return cls(name, starts, np.array([i for i, _ in hot], np.int64), count,
                   len(starts) - 1 + np.r_[0, np.cumsum(parts)][:-1].astype(np.int64), parts, last)

    @property
    def size(self) -> int:
        return len(self.starts) - 1 + int(self.hot_parts.sum())

    def of_key(self, context: np.ndarray, word: np.ndarray, words: int) -> np.ndarray:
        shard = np.searchsorted(self.starts, context, "right") - 1
        if len(self.hot):
            k = np.minimum(np.searchsorted(self.hot, context), len(self.hot) - 1)
            own = self.hot[k] == context
            shard = np.where(own, self.hot_first[k] + word * self.hot_parts[k] // words, shard)
        return shard

    def contexts(self, s: int) -> tuple[int, int, int | None]:
        """First context of a shard, how many, and the count of a hot one."""
        if s < len(self.starts) - 1:
            return int(self.starts[s]), int(self.starts[s + 1] - self.starts[s]), None
        k = int(np.searchsorted(self.hot_first, s, "right")) - 1
        return int(self.hot[k]), 1, int(self.hot_count[k])


@dataclass
class Model:
    """What a task needs beside the files."""

    folder: str
    bits: int  # level one has 2**bits shards
    before: np.ndarray  # words before each shard of level one
    total: int  # N
    texts: int  # training texts
    power: float
    levels: list[Shards] = field(default_factory=list)  # level two, and so on

    @property
    def size(self) -> int:
        return int(self.before[-1])

    def base(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 0.5) / (self.total + 0.5 * (self.size + 1))


_OPEN: OrderedDict[str, object] = kept(__name__, OrderedDict())


def _opened(uri: str, make):
    """``make(buffer)`` of a mapped file, None if there is no such file."""
    if uri not in _OPEN:
        fs, path = open_fs(uri)
        there = fs.get_file_info(path).type != pafs.FileType.NotFound
        _OPEN[uri] = make(open_mapped(uri).read_buffer()) if there else None
        if len(_OPEN) > OPEN:
            _OPEN.popitem(last=False)
    _OPEN.move_to_end(uri)
    return _OPEN[uri]


class _Words:
    """A shard of level one: hashes, and sums of the counts."""

    def __init__(self, buf):
        self.keys = eliasfano.Sequence(buf)
        self.sums = eliasfano.Sequence(buf, self.keys.end)

    def counts(self, i: np.ndarray) -> np.ndarray:
        upto = self.sums.at(np.r_[i, np.maximum(i - 1, 0)]).astype(np.int64)
        return upto[:len(i)] - np.where(i > 0, upto[len(i):], 0)


class _Successors:
    """A shard of a further level: pointers, successors, shares, and what is
    left to the level below after each n-gram."""

    def __init__(self, buf):
        self.first = int(np.frombuffer(buf, np.int64, 1)[0])
        self.pointers = eliasfano.Sequence(buf, 8)
        self.keys = eliasfano.Sequence(buf, self.pointers.end)
        self.share = np.frombuffer(buf, np.uint16, self.keys.n, self.keys.end)
        left = self.keys.end + 2 * self.keys.n
        self.left = np.frombuffer(buf, np.uint16, self.keys.n, left) if len(buf) > left else None

    def find(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Places of words (int64) after contexts, which ascend; -1: not there."""
        new = np.r_[True, context[1:] != context[:-1]]
        k = context[new] - self.first
        at = self.pointers.at(np.r_[k, k + 1]).astype(np.int64) - np.r_[k, k + 1]
        begin, stop = at[:len(k)], at[len(k):]
        base = np.where(begin > 0, self.keys.at(np.maximum(begin - 1, 0)), np.uint64(0))
        back = np.cumsum(new) - 1
        return self.keys.find(word.astype(np.uint64) + np.uint64(1) + base[back], begin[back], stop[back])


def _follow(m: Model, level: Shards, context: np.ndarray, ids: np.ndarray):
    """Of each token the place of its n-gram in ``level`` (-1: not in training),
    its share, and what is left after it to lower levels (1 if there is none)."""
    place, share, left = np.full(len(ids), -1, np.int64), np.zeros(len(ids)), np.ones(len(ids))
    both = np.flatnonzero((ids >= 0) & (context >= 0))
    if not len(both):
        return place, share, left
    v = np.uint64(m.size + 1)
    keys, back = np.unique(context[both].astype(np.uint64) * v + ids[both].astype(np.uint64), return_inverse=True)
    after, word = (keys // v).astype(np.int64), (keys % v).astype(np.int64)
    found, shares, lefts = np.full(len(keys), -1, np.int64), np.zeros(len(keys)), np.ones(len(keys))
    shard = level.of_key(after, word, m.size + 1)
    order = np.argsort(shard, kind="stable")
    cut = np.flatnonzero(np.r_[True, np.diff(shard[order]) != 0, True])
    for a, b in zip(cut[:-1], cut[1:]):
        part = order[a:b]
        s = int(shard[part[0]])
        f = _opened(f"{m.folder}/{level.name}-{s}", _Successors)
        if f is None:
            continue
        k = f.find(after[part], word[part])
        part, k = part[k >= 0], k[k >= 0]
        found[part] = k + (0 if level.last else level.before[s])
        shares[part] = SHARE[f.share[k]]
        if f.left is not None:
            lefts[part] = SHARE[f.left[k]]
    place[both], share[both], left[both] = found[back], shares[back], lefts[back]
    return place, share, left


def _next(x: np.ndarray, bounds: np.ndarray, none) -> np.ndarray:
    """What each token's predecessor in its text has; ``none`` for the first."""
    out = np.r_[np.array([none], x.dtype), x[:-1]]
    out[bounds[:-1]] = none
    return out


def word_ids(m: Model, h: np.ndarray) -> np.ndarray:
    """Ids of word hashes; -1: not a training word. ``h`` ascending."""
    out = np.full(len(h), -1, np.int64)
    shift = np.uint64(64 - m.bits)
    cut = np.searchsorted(h, np.arange(1 << m.bits, dtype=np.uint64) << shift)
    cut = np.r_[cut, len(h)]
    for s in range(1 << m.bits):
        lo, hi = cut[s], cut[s + 1]
        if lo < hi and (level := _opened(f"{m.folder}/words-{s}", _Words)):
            at = level.keys.find(h[lo:hi] - (np.uint64(s) << shift))
            out[lo:hi] = np.where(at >= 0, at + m.before[s], -1)
    return out


def word_counts(m: Model, ids: np.ndarray) -> np.ndarray:
    """Training counts of word ids, ascending; -1: 0. Id V, the beginning of a
    text, counts the training texts."""
    out = np.zeros(len(ids), np.int64)
    out[ids == m.size] = m.texts
    cut = np.searchsorted(ids, m.before)
    for s in range(1 << m.bits):
        lo, hi = cut[s], cut[s + 1]
        if lo < hi:
            out[lo:hi] = _opened(f"{m.folder}/words-{s}", _Words).counts(ids[lo:hi] - m.before[s])
    return out


def _pairs(m: Model, texts: list[bytes]):
    """ids, their counts, contexts (V at the beginning) and text bounds."""
    h, bounds = tokens(texts)
    one, back = np.unique(h, return_inverse=True)
    one_ids = word_ids(m, one)
    order = np.argsort(one_ids, kind="stable")
    counts = np.zeros(len(one), np.int64)
    counts[order] = word_counts(m, one_ids[order])
    ids, counts = one_ids[back], counts[back]
    context, of_context = np.r_[m.size, ids[:-1]], np.r_[m.texts, counts[:-1]]
    context[bounds[:-1]], of_context[bounds[:-1]] = m.size, m.texts
    return ids, counts, context, of_context, bounds


def _level_one(docs: DataFrame, folder: str, text_col: str, bits: int, shard_tokens: int) -> list:
    shift = np.uint64(64 - bits)
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def count(it):
        pack = zstandard.ZstdCompressor(level=1)
        keys, counts, texts = np.empty(0, np.uint64), np.empty(0, np.int64), 0
        for g in _groups(it, text_col):
            t = text_bytes(g.column(0))
            texts += len(t)
            k, c = np.unique(tokens(t)[0], return_counts=True)
            keys, counts = _summed(np.r_[keys, k], np.r_[counts, c])
            if len(keys) > 1 << 21:
                yield from out(pack, keys, counts, texts)
                keys, counts, texts = keys[:0], counts[:0], 0
        if texts:
            yield from out(pack, keys, counts, texts)

    def out(pack, keys, counts, texts):
        cut = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << shift).tolist() + [len(keys)]
        some = [s for s in range(1 << bits) if cut[s] < cut[s + 1]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()),
             pa.array([pack.compress(keys[cut[s]:cut[s + 1]].tobytes()) for s in some], pa.binary()),
             pa.array([pack.compress(counts[cut[s]:cut[s + 1]].tobytes()) for s in some], pa.binary()),
             pa.array([texts if s == some[0] else 0 for s in some], pa.int64())],
            names=["shard", "keys", "counts", "texts"])

    def build(it):
        for s, rows in _by_shard(it):
            keys, counts = _merged(rows, np.uint64)
            sums = np.cumsum(counts).astype(np.uint64)
            _put(f"{folder}/words-{s}", eliasfano.encode(keys - (np.uint64(s) << shift), 1 << (64 - bits))
                 + eliasfano.encode(sums, int(sums[-1]) + 1))
            # contexts with over a shard's tokens; there are at most N / shard_tokens
            top = np.flatnonzero(counts > shard_tokens)
            yield pa.RecordBatch.from_arrays(
                [pa.array([s], pa.int32()), pa.array([len(keys)], pa.int64()), pa.array([counts.sum()], pa.int64()),
                 pa.array([sum(r[3] for r in rows)], pa.int64()), pa.array([top.tolist()], pa.list_(pa.int64())),
                 pa.array([counts[top].tolist()], pa.list_(pa.int64()))],
                names=["shard", "v", "n", "texts", "top", "of"])

    sent = docs.select(text_col).transform(mapped, count, "shard int, keys binary, counts binary, texts long")
    return (sent.repartition(tasks, "shard").sortWithinPartitions("shard")
            .transform(mapped, build, "shard int, v long, n long, texts long, top array<long>, of array<long>").collect())


def _by_shard(it):
    """Rows of each shard; a shard's rows are sums, not tokens."""
    now, held = None, []
    for b in it:
        for r in zip(*(c.to_pylist() for c in b.columns)):
            if held and r[0] != now:
                yield now, held
                held = []
            now = r[0]
            held.append(r)
    if held:
        yield now, held


def _merged(rows, dtype) -> tuple[np.ndarray, np.ndarray]:
    """Summed counts of a shard's packed (keys, counts), a few rows at a time."""
    unpack = zstandard.ZstdDecompressor()
    keys, counts = np.empty(0, dtype), np.empty(0, np.int64)
    held, size = [], 0
    for k, r in enumerate(rows):
        held.append((np.frombuffer(unpack.decompress(r[1]), dtype), np.frombuffer(unpack.decompress(r[2]), np.int64)))
        size += len(held[-1][0])
        if size > max(1 << 20, len(keys)) or k == len(rows) - 1:
            keys, counts = _summed(np.concatenate([keys, *(x for x, _ in held)]),
                                   np.concatenate([counts, *(c for _, c in held)]))
            held, size = [], 0
    return keys, counts


def _level(docs: DataFrame, model: Model, level: Shards, text_col: str, shard_tokens: int) -> list:
    """Write the next level of ``model``; a row for each shard."""
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = spark.sparkContext.broadcast((model, level))

    def count(it):
        pack = zstandard.ZstdCompressor(level=1)
        m, lv = shared.value
        v = np.uint64(m.size + 1)
        for g in _groups(it, text_col):
            ids, _, context, _, bounds = _pairs(m, text_bytes(g.column(0)))
            for below in m.levels:
                context = _next(_follow(m, below, context, ids)[0], bounds, -1)
            some = context >= 0
            keys, counts = np.unique(context[some].astype(np.uint64) * v + ids[some].astype(np.uint64),
                                     return_counts=True)
            if not len(keys):
                continue
            shard = lv.of_key((keys // v).astype(np.int64), (keys % v).astype(np.int64), m.size + 1)
            order = np.argsort(shard, kind="stable")
            cut = np.flatnonzero(np.r_[True, np.diff(shard[order]) != 0, True])
            parts = [order[a:b] for a, b in zip(cut[:-1], cut[1:])]
            # steps from key to key are small numbers, which pack well
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard[order[cut[:-1]]], pa.int64()),
                 pa.array([pack.compress(_planes(np.diff(keys[p], prepend=np.uint64(0)))) for p in parts], pa.binary()),
                 pa.array([pack.compress(_planes(counts[p].astype(np.uint64))) for p in parts], pa.binary())],
                names=["shard", "keys", "counts"])

    def build(it):
        m, lv = shared.value
        unpack = zstandard.ZstdDecompressor()
        v = np.uint64(m.size + 1)
        for s, rows in _by_shard(it):
            held = [(np.cumsum(_unplanes(unpack.decompress(r[1]))), _unplanes(unpack.decompress(r[2]))) for r in rows]
            keys, counts = _summed(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))
            del held
            first, many, of = lv.contexts(s)
            context, word = (keys // v).astype(np.int64) - first, keys % v + np.uint64(1)
            begin = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
            sizes = np.diff(np.r_[begin, len(keys)])
            pointers = np.zeros(many + 1, np.int64)
            pointers[context[begin] + 1] = sizes
            pointers = (np.cumsum(pointers) + np.arange(many + 1)).astype(np.uint64)
            ends = np.cumsum(word[begin + sizes - 1])  # the last numbers of the contexts
            word += np.repeat(np.r_[np.uint64(0), ends[:-1]], sizes)
            c = np.repeat(np.add.reduceat(counts, begin) if of is None else np.uint64(of), sizes if of is None
                          else len(keys)).astype(np.float64)
            share, left = counts / (c + c ** m.power), counts ** (m.power - 1)
            _put(f"{m.folder}/{lv.name}-{s}", np.int64(first).tobytes()
                 + eliasfano.encode(pointers, int(pointers[-1]) + 1) + eliasfano.encode(word, int(word[-1]) + 1)
                 + _code(share) + (b"" if lv.last else _code(left / (1 + left))))
            top = np.flatnonzero(counts > shard_tokens) if not lv.last else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([s], pa.int64()), pa.array([len(keys)], pa.int64()),
                 pa.array([top.tolist()], pa.list_(pa.int64())),
                 pa.array([counts[top].tolist()], pa.list_(pa.int64()))], names=["shard", "n", "top", "of"])

    sent = docs.select(text_col).transform(mapped, count, "shard long, keys binary, counts binary")
    return (sent.repartition(tasks, "shard").sortWithinPartitions("shard")
            .transform(mapped, build, "shard long, n long, top array<long>, of array<long>").collect())


def _planes(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _unplanes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def train(docs: DataFrame, folder: str, power: float = 0.85, text_col: str = "text",
          shard_tokens: int = SHARD_TOKENS, order: int = 2) -> Model:
    """Learn n-grams of up to ``order`` words from every text of ``docs``
    (null: empty) and write the trie under ``folder``. Counts cover all rows;
    the driver gets one row for each shard. No rows: a model without words."""
    spark = docs.sparkSession
    folder = folder.rstrip("/")
    make_dir(folder)
    docs = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias(text_col))
    bits = max(1, (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    rows = {r.shard: r for r in _level_one(docs, folder, text_col, bits, shard_tokens)}
    sizes = [rows[s].v if s in rows else 0 for s in range(1 << bits)]
    before = np.r_[0, np.cumsum(sizes, dtype=np.int64)]
    total, texts = sum(r.n for r in rows.values()), sum(r.texts for r in rows.values())
    model = Model(folder, bits, before, total, texts, power)
    release(spark)
    shards = 1 + total // shard_tokens
    starts = -(-np.arange(shards + 1, dtype=np.int64) * (model.size + 1) // shards)
    hot = sorted((int(before[s]) + i, c) for s, r in rows.items() for i, c in zip(r.top, r.of))
    if texts > shard_tokens:
        hot.append((model.size, texts))
    for n in range(2, order + 1 if total else 2):
        level = Shards.of(f"level{n}", starts, hot, shard_tokens, n == order)
        found = {r.shard: r for r in _level(docs, model, level, text_col, shard_tokens)}
        # an n-gram's place is its id as a context, and a shard's n-grams are contexts of one shard
        sizes = [found[s].n if s in found else 0 for s in range(level.size)]
        starts = level.before = np.r_[0, np.cumsum(sizes, dtype=np.int64)]
        hot = sorted((int(starts[s]) + i, c) for s, r in found.items() for i, c in zip(r.top, r.of))
        model.levels.append(level)
        release(spark)
    return model


ADDED = T.StructType().add("n_tokens", "long").add("n_known", "long").add("base_score", "double").add("score", "double")


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with n_tokens (words and the end), n_known (those that are
    training words), base_score (log10 under single words) and score (log10
    under the trie). Null texts are empty and have the end alone. Other columns
    stay; existing columns of the new names are replaced."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    src = docs.drop(*ADDED.names)
    at = src.columns.index(text_col)
    schema = T.StructType([*src.schema.fields, *ADDED.fields])

    def run(it):
        m = shared.value
        for g in _groups(it, text_col):
            ids, counts, context, of_context, bounds = _pairs(m, text_bytes(g.column(at)))
            p = m.base(counts)
            base = np.log10(p)
            # what smoothing leaves to single words; all of it after a word that is not in training
            weight = of_context.astype(np.float64) ** m.power
            left = np.where(of_context > 0, weight / np.maximum(of_context + weight, 1.0), 1.0)
            for level in m.levels:
                place, share, after = _follow(m, level, context, ids)
                p = share + left * p
                context, left = _next(place, bounds, -1), _next(after, bounds, 1.0)
            full = np.log10(p)
            add = lambda x: np.add.reduceat(x, bounds[:-1])  # noqa: E731  each text has a token
            yield pa.RecordBatch.from_arrays(
                [*g.columns, pa.array(np.diff(bounds), pa.int64()), pa.array(add((ids >= 0).astype(np.int64))),
                 pa.array(add(base)), pa.array(add(full))], names=[*g.schema.names, *ADDED.names])

    return src.transform(mapped, run, schema)
