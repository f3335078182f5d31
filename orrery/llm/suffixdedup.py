"""Removal of repeated byte strings by suffix sorting in buckets.

A byte goes if it lies in a string of ``length`` bytes that starts anywhere
else too. Sorting all suffixes would move the whole corpus several times, so
the suffixes are first cut into buckets whose members alone can share a prefix
of that length, and buckets are sorted one batch after the other:

1. Each window of ``length`` bytes has an anchor: the place inside it whose
   ``GRAM`` bytes have the least hash (the last of equals). Equal windows have
   equal anchors at equal places. The windows of one anchor form a span. Spans
   are counted by anchor hash; an anchor that occurs once bounds no repeat.
2. A span that occurs whole a second time (equal text, equal shape) repeats
   with all its windows. What is left are the spans at the edges of repeats.
3. Those are sorted as suffixes. A bucket holds the suffixes with the same
   anchor at the same distance. A difference cover modulo ``V`` picks sample
   places; their ranks are found first, by doubling, and two suffixes are
   compared by the few bytes before their next sample place and then by its
   rank, however long they agree. Neighbours that agree on ``length`` bytes,
   byte by byte, are repeats.

Anchors shared by more than ``crowd`` different spans are not sorted in one
task: each of their windows becomes a row with its hash, and equal rows are
counted by Spark.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.llm import bytehash
from orrery.llm.common import batches, free_name, mapped, release, text_bytes
from orrery.session import drop_stage, stage_path

GRAM = 40
V = 64
PIECE = 1 << 18  # window starts that are worked on at once
BATCH = 4 << 20  # bytes of spans that are sorted at once
CROWD = BATCH // 512  # spans of an anchor that a task sorts: their texts are within BATCH
LOW = np.uint64(0xFFFFFF)


def difference_cover(v: int) -> np.ndarray:
    """Residues D such that every residue is a difference of two of D, and that
    hold one of each ``sqrt(v)`` consecutive residues."""
    r = int(np.sqrt(v))
    if r * r != v:
        raise ValueError("v must be a square")
    return np.unique(np.r_[np.arange(r), np.arange(0, v, r)])


COVER = difference_cover(V)
_NEXT = np.array([min((c - r) % V for c in COVER.tolist()) for r in range(V)])  # bytes to the next sample place


def windows_by_anchor(buf: np.ndarray, first: np.ndarray, last: np.ndarray, length: int):
    """Spans of the windows that start in the ranges [first, last) of ``buf``:
    anchor place, first and last window start, range, anchor hash, span hash."""
    width = length - GRAM + 1
    s = bytehash.running(buf)
    at = np.arange(len(buf) - GRAM + 1)
    gram = bytehash.spans(s, at, at + GRAM)
    # the least hash wins, the last place among equals; sliding minimum over blocks of the window's width
    key = (gram & ~LOW) | (LOW - at.astype(np.uint64))
    pad = -len(key) % width
    block = np.concatenate([key, np.full(pad, ~np.uint64(0))]).reshape(-1, width)
    head = np.minimum.accumulate(block, axis=1).ravel()
    tail = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    n = last - first
    part = np.repeat(np.arange(len(n)), n)
    start = np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)
    anchor = (LOW - (np.minimum(tail[start], head[start + width - 1]) & LOW)).astype(np.int64)
    cut = np.flatnonzero(np.r_[True, (np.diff(anchor) != 0) | (np.diff(part) != 0)])
    lo, hi = start[cut], start[np.r_[cut[1:] - 1, len(start) - 1]]
    p = anchor[cut]
    shape = ((p - lo) * 4096 + (hi - lo)).astype(np.uint64)
    span = bytehash.spans(s, lo, hi + length) ^ bytehash.mix(shape * np.uint64(bytehash.M) + np.uint64(1))
    return p, lo, hi, part[cut], gram[p], span


def pieces(texts: list[bytes], length: int):
    """Cut texts into ranges of at most PIECE window starts and yield them in
    buffers of about that size: (buffer, first, last, row, base of each)."""
    held, size = [], 0
    for row, t in enumerate(texts):
        for a in range(0, len(t) - length + 1, PIECE):
            b = min(a + PIECE, len(t) - length + 1)
            if held and size + b - a + length > PIECE + length:
                yield _joined(held, length)
                held, size = [], 0
            held.append((row, a, t[a:b + length - 1]))
            size += b - a + length - 1
    if held:
        yield _joined(held, length)


def _joined(held, length):
    sizes = np.array([len(h[2]) for h in held])
    first = np.cumsum(sizes) - sizes
    return (np.frombuffer(b"".join(h[2] for h in held), np.uint8), first, first + sizes - length + 1,
            np.array([h[0] for h in held]), np.array([h[1] for h in held]))


# a span's place in one long: first window, number of windows after it, anchor after the first window
def pack(lo, more, off):
    return (lo << 24) | (more << 12) | off


def unpack(at):
    return at >> 24, (at >> 12) & 4095, at & 4095


SPANS = "cls long, span long, k1 long, k2 int, at long"


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(k1, k2, text): rows are known by 96 bits of their id and text; rows
    equal in both are repeats of each other and share what is found."""
    return docs.select(F.xxhash64(id_col, text_col).alias("k1"), F.hash(id_col, text_col).alias("k2"),
                       F.col(text_col).alias("text"))


def spans(rows: DataFrame, length: int) -> DataFrame:
    """Spans of all rows of ``keyed``."""

    def run(it):
        for b in batches(it, 4 << 20, "text"):
            k1, k2 = b.column(0).to_numpy(), b.column(1).to_numpy()
            for buf, first, last, row, base in pieces(text_bytes(b.column(2)), length):
                p, lo, hi, part, cls, span = windows_by_anchor(buf, first, last, length)
                r = row[part]
                at = pack(lo - first[part] + base[part], hi - lo, p - lo)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cls.view(np.int64)), pa.array(span.view(np.int64)), pa.array(k1[r]),
                     pa.array(k2[r]), pa.array(at)], names=["cls", "span", "k1", "k2", "at"])

    return rows.where(F.octet_length("text") >= length).transform(mapped, run, SPANS)


def sample_ranks(buf: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of the suffixes at the sample ``places`` (ascending, closed under
    steps of V up to the buffer's end) by their first ``depth`` bytes."""
    eight = np.ndarray(len(buf) - 7, ">u8", buf, strides=(1,))
    keys = [eight[places + k].astype(np.uint64) for k in range(V - 8, -1, -8)]
    order = np.lexsort(keys)
    new = np.zeros(len(places), bool)
    for k in keys:
        new[1:] |= k[order[1:]] != k[order[:-1]]
    rank = np.empty(len(places), np.int64)
    rank[order] = np.cumsum(new)
    h = V
    where = np.full(len(buf) + 1, -1, np.int32)
    where[places] = np.arange(len(places))
    while h < depth:
        nxt = where[np.minimum(places + h, len(buf))]
        pair = rank * (len(places) + 2) + np.where(nxt >= 0, rank[nxt] + 1, 0)
        rank = np.unique(pair, return_inverse=True)[1]
        h *= 2
    return rank


def repeated_windows(texts: list[bytes], cls: np.ndarray, off: np.ndarray, length: int):
    """Of every window of every span, whether an equal window lies in another
    span of its class. Returns spans, window numbers and flags."""
    sizes = np.array([len(t) for t in texts])
    # each span is laid so that its anchor is at a multiple of V: equal windows then have equal residues
    room = -(-(sizes + 2 * V) // V) * V
    begin = np.cumsum(room) - room + V - off % V
    total = int(room.sum()) + 2 * length + 4 * V
    buf = np.zeros(total, np.uint8)
    flat = np.frombuffer(b"".join(texts), np.uint8)
    buf[np.arange(len(flat)) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)] = flat
    member = np.zeros(V, bool)
    member[COVER] = True
    places = np.flatnonzero(np.tile(member, total // V + 1)[:total - V])
    rank = sample_ranks(buf, places, length)
    of_place = np.full(total, -1, np.int32)
    of_place[places] = np.arange(len(places))
    n = sizes - length + 1
    span = np.repeat(np.arange(len(texts)), n)
    number = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = begin[span] + number
    step = _NEXT[at % V]
    eight = np.ndarray(total - 7, ">u8", buf, strides=(1,))
    # the bytes before the next sample place, at most seven
    before = np.where(step > 0, eight[at].astype(np.uint64) >> (np.uint64(64) - np.uint64(8) * np.maximum(
        step, 1).astype(np.uint64)), np.uint64(0))
    bucket = cls[span] * 4096 + (number - off[span] + 4095) % 4096
    order = np.lexsort((rank[of_place[at + step]], before, bucket))
    a, b = at[order[:-1]], at[order[1:]]
    same = bucket[order[:-1]] == bucket[order[1:]]
    for k in [*range(0, length - 7, 8), length - 8]:
        same[same] = eight[a[same] + k] == eight[b[same] + k]
    flag = np.zeros(len(at), bool)
    flag[order[:-1][same]] = True
    flag[order[1:][same]] = True
    return span, number, flag


def _runs(flag: np.ndarray, span: np.ndarray, number: np.ndarray):
    """Runs of flagged windows: span, first and last window."""
    cut = np.flatnonzero(flag)
    new = np.r_[True, (np.diff(cut) != 1) | (np.diff(span[cut]) != 0)] if len(cut) else np.zeros(0, bool)
    first = cut[new]
    last = cut[np.r_[new[1:], True]] if len(cut) else cut
    return span[first], number[first], number[last]


def _sorted_buckets(contexts: DataFrame, length: int) -> DataFrame:
    """Repeated runs (k1, k2, lo, hi) in bytes of the spans that occur once."""

    def flush(rows):
        cls = np.array([r[0] for r in rows])
        cls = np.unique(cls, return_inverse=True)[1]
        lo, _, off = unpack(np.array([r[4] for r in rows], np.int64))
        span, number, flag = repeated_windows([r[6] for r in rows], cls, off, length)
        single = np.array([r[5] for r in rows])
        s, a, b = _runs(flag & single[span], span, number)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.array([r[2] for r in rows], np.int64)[s]), pa.array(np.array([r[3] for r in rows], np.int32)[s]),
             pa.array(lo[s] + a), pa.array(lo[s] + b + length)], names=["k1", "k2", "lo", "hi"])

    def run(it):
        held, size, last = [], 0, None
        for b in it:
            for r in zip(*(c.to_pylist() for c in b.columns)):
                if size >= BATCH and r[0] != held[-1][0]:
                    yield flush(held)
                    held, size, last = [], 0, None
                if last == r[:2]:  # a whole span's text is needed once
                    continue
                last = r[:2]
                held.append(r)
                size += len(r[6])
        if held:
            yield flush(held)

    n = int(contexts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = contexts.select("cls", "span", "k1", "k2", "at", "single", "body").repartition(
        n, "cls").sortWithinPartitions("cls", "span")
    return dealt.transform(mapped, run, "k1 long, k2 int, lo long, hi long")


def _counted_windows(contexts: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many spans: windows are counted as rows."""

    def run(it):
        for b in it:
            for lo, hi in ((k, min(k + 512, b.num_rows)) for k in range(0, b.num_rows, 512)):
                c = b.slice(lo, hi - lo)
                texts = text_bytes(c.column(6))
                sizes = np.array([len(t) for t in texts])
                begin = np.cumsum(sizes) - sizes
                s = bytehash.running(np.frombuffer(b"".join(texts), np.uint8))
                n = sizes - length + 1
                r = np.repeat(np.arange(len(n)), n)
                number = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                start, _, off = unpack(c.column(4).to_numpy())
                h = bytehash.spans(s, begin[r] + number, begin[r] + number + length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.column(0).to_numpy()[r]), pa.array((number - off[r]).astype(np.int32)),
                     pa.array(h.view(np.int64)), pa.array(c.column(2).to_numpy()[r]),
                     pa.array(c.column(3).to_numpy()[r]), pa.array(start[r] + number),
                     pa.array(c.column(5).to_numpy(zero_copy_only=False)[r])],
                    names=["cls", "o", "h", "k1", "k2", "lo", "single"])

    one = contexts.dropDuplicates(["cls", "span"]).select("cls", "span", "k1", "k2", "at", "single", "body")
    rows = one.transform(mapped, run, "cls long, o int, h long, k1 long, k2 int, lo long, single boolean")
    key = ["cls", "o", "h"]
    many = rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return (rows.where("single").join(many, key)
            .select("k1", "k2", "lo", (F.col("lo") + length).alias("hi")))


def _contexts(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """Texts of the spans ``wanted(k1, k2, cls, span, at, single, crowded)``.
    Rows of equal keys are copies: their spans are wanted once, of one copy."""
    lists = wanted.groupBy("k1", "k2").agg(
        F.collect_set(F.struct("cls", "span", "at", "single", "crowded")).alias("want"))
    src = rows.dropDuplicates(["k1", "k2"]).join(lists, ["k1", "k2"])
    schema = "cls long, span long, k1 long, k2 int, at long, single boolean, body binary, crowded boolean"

    def run(it):
        for b in batches(it, 4 << 20, "text"):
            out = [[] for _ in range(8)]
            for k1, k2, text, want in zip(*(b.column(k).to_pylist() for k in range(4))):
                data = text.encode()
                for w in want:
                    lo, more, _ = unpack(w["at"])
                    for col, v in zip(out, (w["cls"], w["span"], k1, k2, w["at"], w["single"],
                                            data[lo:lo + more + length], w["crowded"])):
                        col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (
                    pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.binary(), pa.bool_()))],
                names=["cls", "span", "k1", "k2", "at", "single", "body", "crowded"])

    return src.transform(mapped, run, schema)


def repeats(docs: DataFrame, length: int = 200, crowd: int = CROWD, id_col: str = "doc_id",
            text_col: str = "text") -> tuple[DataFrame, str]:
    """(k1, k2, found): for every row of ``docs`` with repeats its byte ranges,
    overlapping and in any order; and the folder that holds them."""
    if not GRAM < length <= 4000:
        raise ValueError(f"length must be over {GRAM} and at most 4000")
    spark = docs.sparkSession

    def write(df: DataFrame, name: str) -> tuple[DataFrame, str]:
        path = stage_path(spark, f"suffix-{name}")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    rows = keyed(docs, id_col, text_col)
    every, p_every = write(spans(rows, length), "spans")
    shared = (every.groupBy("cls").agg(F.count("*").alias("n"), F.min("span").alias("a"), F.max("span").alias("b"))
              .where("n > 1").select("cls", (F.col("a") != F.col("b")).alias("mixed")))
    # a written table, not the aggregate itself: only then can Spark split a hot anchor's rows in the join
    shared, p_shared = write(shared, "anchors")
    again, p_again = write(every.join(shared, "cls"), "shared")
    drop_stage(spark, p_every, p_shared)
    release(spark)
    mixed = again.where("mixed")
    kinds = mixed.groupBy("cls", "span").agg(F.count("*").alias("n"), F.min("k1").alias("rep"))
    kinds, p_kinds = write(kinds, "kinds")
    edges = (kinds.groupBy("cls").agg(F.count("*").alias("spans"), F.min("n").alias("least"))
             .select("cls", (F.col("least") == 1).alias("open"), (F.col("spans") > crowd).alias("crowded")))
    edges, p_edges = write(edges, "edges")
    told, p_told = write(mixed.join(kinds.join(edges, "cls"), ["cls", "span"]), "told")
    release(spark)
    lo, more = F.shiftright("at", 24), F.shiftright("at", 12).bitwiseAND(F.lit(4095))
    whole = (again.where("NOT mixed").select("k1", "k2", "at")
             .unionByName(told.where("n > 1").select("k1", "k2", "at"))
             .select("k1", "k2", lo.alias("lo"), (lo + more + length).alias("hi")))
    wanted = told.where("open AND (n = 1 OR k1 = rep)").select(
        "k1", "k2", "cls", "span", "at", (F.col("n") == 1).alias("single"), "crowded")
    contexts, p_contexts = write(_contexts(rows, wanted, length), "contexts")
    release(spark)
    found = (whole.unionByName(_sorted_buckets(contexts.where("NOT crowded"), length))
             .unionByName(_counted_windows(contexts.where("crowded"), length)))
    # a set: copies of a row find the same ranges, and each copy gets the list
    lists, p_lists = write(found.groupBy("k1", "k2").agg(F.collect_set(F.struct("lo", "hi")).alias("found")), "lists")
    drop_stage(spark, p_again, p_kinds, p_edges, p_told, p_contexts)
    release(spark)
    return lists, p_lists


ADDED = T.StructType().add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept", "binary")


def remove_repeats(docs: DataFrame, length: int = 200, crowd: int = CROWD, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans (maximal removed runs) and
    kept (the bytes that stay): every byte goes that is covered by a string of
    ``length`` bytes that also starts elsewhere, in the same text or another.
    Overlaps count, and strings are judged on the input.

    Texts are UTF-8 bytes; null: empty, as are texts shorter than ``length``
    never cut. Rows equal in id and text are copies of each other. Null ids are
    ids like others. Other columns stay; existing columns of the new names are
    replaced. An empty table stays empty. Spans are told apart by 64-bit
    hashes, and by their bytes where they are sorted."""
    lists, _ = repeats(docs, length, crowd, id_col, text_col)
    src = docs.drop(*ADDED.names)
    columns = src.columns
    # names that no column has, whatever the caller's are
    k1, k2, found = (free_name(columns, x) for x in ("k1", "k2", "found"))
    lists = lists.select(F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("found").alias(found))
    src = src.withColumns({k1: F.xxhash64(id_col, text_col), k2: F.hash(id_col, text_col)})
    src = src.join(lists, [k1, k2], "left").select(*columns, found)
    at = columns.index(text_col)
    schema = T.StructType([*docs.select(*columns).schema.fields, *ADDED.fields])

    def run(it):
        for b in batches(it, 8 << 20, text_col):
            n, removed, runs, kept = [], [], [], []
            for data, f in zip(text_bytes(b.column(at)), b.column(len(columns)).to_pylist()):
                n.append(len(data))
                if not f:
                    removed.append(0)
                    runs.append(0)
                    kept.append(data)
                    continue
                out, cuts, end, stop = [], 0, 0, -1
                for lo, hi in sorted((x["lo"], x["hi"]) for x in f):
                    if lo > stop:
                        cuts += 1
                        out.append(data[end:lo])
                    stop = max(stop, hi)
                    end = stop
                out.append(data[end:])
                kept.append(b"".join(out))
                removed.append(len(data) - len(kept[-1]))
                runs.append(cuts)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()),
                 pa.array(kept, pa.binary())], names=[*columns, *ADDED.names])

    return src.transform(mapped, run, schema)

