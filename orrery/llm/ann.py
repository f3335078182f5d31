"""Approximate nearest neighbours by largest inner product, over several
shifted Hilbert orderings of projected vectors.

Each curve projects the vectors on a few random directions, shifts and
quantises them and takes the Hilbert key of the grid cell, to the resolution of
single precision. Spark sorts all keys by range; the sorted order is cut in
blocks, and a query is compared with the blocks within a window around its
place, on every curve. What the curves find is merged and ranked by the exact
measure.

The window is measured on the table: a sample of the queries is searched
exactly, and the window is as wide as it takes to find the wanted share of
their true neighbours. Where that is wider than the table is worth, every query
is compared with every entry.

Vectors are dealt by the power of two next to their length. In such a range
they get one more component, which makes them equally long without changing the
order of inner products with a query; every range is searched.

Equal vectors are indexed once, with the smallest ids that share them, so that
a vector with any number of copies is one entry in the order.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orrery.llm.common import mapped
from orrery.session import cut_lineage

AXES, LEVELS, WORDS = 8, 8, 3  # three 64-bit words a key
RANGES = 32  # of lengths; all shorter vectors are in the last


def hilbert(cells: np.ndarray, levels: int) -> np.ndarray:
    """Hilbert index (uint64) of grid cells: rows of ``axes`` coordinates of
    ``levels`` bits, by the transpose form of the curve."""
    x = cells.astype(np.int64).T.copy()
    _transpose(x, levels)
    return _interleave(x, levels)


def _transpose(x: np.ndarray, levels: int) -> None:
    axes = len(x)
    for bit in range(levels - 1, 0, -1):
        q, low = 1 << bit, (1 << bit) - 1
        for i in range(axes):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(flip, low, swap)
            x[i] ^= swap
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    for bit in range(levels - 1, 0, -1):
        turn ^= np.where(x[-1] & (1 << bit), (1 << bit) - 1, 0)
    x ^= turn


def _interleave(x: np.ndarray, levels: int) -> np.ndarray:
    key = np.zeros(x.shape[1], np.uint64)
    for bit in range(levels - 1, -1, -1):
        for row in x:
            key = (key << np.uint64(1)) | ((row >> bit) & 1).astype(np.uint64)
    return key


def hilbert_words(cells: np.ndarray, words: int) -> list[np.ndarray]:
    """The Hilbert index of cells of ``words * LEVELS`` bits a coordinate, as
    words (uint64) from the highest: the curve of the upper bits is the same,
    so the first word is that of a coarse grid and the next ones order its cells."""
    x = cells.astype(np.int64).T.copy()
    _transpose(x, words * LEVELS)
    return [_interleave(x >> (LEVELS * w), LEVELS) for w in range(words - 1, -1, -1)]


def curve_keys(v: np.ndarray, curve: int, seed: int) -> list[np.ndarray]:
    """Signed sort keys of unit vectors on one curve, word by word."""
    rng = np.random.default_rng([seed, curve])
    axes = min(AXES, v.shape[1])
    directions, _ = np.linalg.qr(rng.normal(size=(v.shape[1], axes)))
    # a component has about 1/sqrt(dim) of the length; three of those to either side fill half of the grid
    spread = v @ directions * np.sqrt(v.shape[1])
    place = np.clip((spread + 3) / 12 + rng.random(axes) / 2, 0, 1 - 1e-9)
    words = hilbert_words((place * (1 << LEVELS * WORDS)).astype(np.int64), WORDS)
    return [(w ^ np.uint64(1 << 63)).view(np.int64) for w in words]


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def distinct_vectors(vectors: DataFrame, every: int, keep: int, id_col: str, vec_col: str) -> DataFrame:
    """(gid, vec, ids, asks): each vector that takes part once, with its
    ``keep`` smallest ids (gid the first) and whether a query has it."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec")).where(
        "id IS NOT NULL AND vec IS NOT NULL")
    fine = (F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists("vec", lambda x: x != 0))
    # forall and exists over null elements give null: such vectors take no part
    rows = rows.where(F.coalesce(fine, F.lit(False)))
    sizes = rows.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = sizes.dim if sizes else 0
    rows = rows.where(F.size("vec") == dim)
    one = rows.groupBy("vec").agg(F.min("id").alias("gid"), F.max(F.col("id") % every == 0).alias("asks"))
    least = (rows.distinct().withColumn("rn", F.row_number().over(Window.partitionBy("vec").orderBy("id")))
             .where(F.col("rn") <= keep).groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    return one.join(least, "vec").select("gid", "vec", "ids", "asks")


def best_of(query: np.ndarray, asked: np.ndarray, data: np.ndarray, gid: np.ndarray, m: int):
    """(asked, gid, score) of the ``m`` best entries of each query, by score,
    then by gid. ``asked`` names the queries."""
    m = min(m, len(gid))
    step = max(1, (1 << 22) // len(gid))  # scores held at a time
    out = []
    for lo in range(0, len(query), step):
        score = query[lo:lo + step] @ data.T
        least = np.partition(score, len(gid) - m, axis=1)[:, len(gid) - m]
        row, col = np.nonzero(score >= least[:, None])
        value = score[row, col]
        order = np.lexsort((gid[col], -value, row))
        first = np.searchsorted(row, np.arange(len(score)))
        order = order[np.arange(len(row)) - first[row] < m]
        out.append((asked[lo:lo + step][row[order]], gid[col[order]], value[order]))
    return [np.concatenate(x) for x in zip(*out)]


def window_needed(base: DataFrame, placed: DataFrame, k: int, curves: int, sample: int, recall: float, seed: int) -> int:
    """Entries to either side of a query's place, on every curve, among which
    ``recall`` of the true ``k`` nearest entries of ``sample`` queries lie."""
    spark = base.sparkSession
    some = base.where("asks").orderBy(F.xxhash64("gid", F.lit(seed)), "gid").select("gid", "vec").limit(sample).collect()
    if not some:
        return 0
    asked, q = np.array([r.gid for r in some]), np.array([r.vec for r in some], np.float64)

    def exact(it):
        held = None
        for b in it:
            if not b.num_rows:
                continue
            got = best_of(q, asked, _matrix(b.column(1), q.shape[1]), b.column(0).to_numpy(), k + 1)
            got = got if held is None else [np.concatenate(x) for x in zip(held, got)]
            order = np.lexsort((got[1], -got[2], got[0]))
            ask = got[0][order]
            held = [x[order][np.arange(len(ask)) - np.searchsorted(ask, ask) <= k] for x in got]
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], names=["ask", "gid", "score"])

    best = Window.partitionBy("ask").orderBy(F.desc("score"), "gid")
    pairs = (base.select("gid", "vec").transform(mapped, exact, "ask long, gid long, score double").where("ask != gid")
             .withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= k).select("ask", "gid").collect())
    if not pairs:
        return 0
    near = sorted({r.gid for r in pairs})
    marks = spark.createDataFrame([(int(g), True) for g in asked] + [(g, False) for g in near], "gid long, query boolean")
    found = placed.join(F.broadcast(marks), ["gid", "query"]).select("gid", "query", "slot", "pos").toPandas()
    of_query = {(g, s): p for g, s, p in found[found["query"]][["gid", "slot", "pos"]].itertuples(index=False)}
    of_entry = {}
    for g, s, p in found[~found["query"]][["gid", "slot", "pos"]].itertuples(index=False):
        of_entry.setdefault(g, []).append((s, p))
    needs = []
    for r in pairs:
        away = [p - of_query[r.ask, s] for s, p in of_entry[r.gid]]
        needs.append(min(d + 1 if d >= 0 else -d for d in away))
    return int(np.quantile(needs, recall, method="higher"))


def search(vectors: DataFrame, k: int = 20, every: int = 20, curves: int = 36, block: int = 384, seed: int = 7,
           id_col: str = "vec_id", vec_col: str = "embedding", recall: float = 0.95, sample: int = 200) -> DataFrame:
    """For every row whose id is divisible by ``every``: (query_id, rank,
    vec_id, score) of its ``k`` nearest found among all rows but itself, by
    inner product, ties to the smaller id.

    The window on each curve is at least ``block`` entries to either side, and
    as many as find ``recall`` of the nearest of ``sample`` queries, which are
    searched exactly. If the windows needed came to more than twice the table,
    every query is compared with every entry.

    Vectors that are null, zero, or hold null or non-finite components take no
    part, nor do rows without an id or vectors of another size than the most
    frequent one. Fewer candidates than ``k``: all that are found; tables of up
    to ``block`` rows are searched whole. Rows equal in id and vector count
    once. Empty table: empty result. Other columns are not read."""
    spark = vectors.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = cut_lineage(distinct_vectors(vectors, every, k + 1, id_col, vec_col), "ann-vectors")
    square = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    # half powers of two are the borders, so that unit vectors share a range
    octave = F.floor(F.log2(F.col("square")) / 2 + 0.5).cast("int")
    lengths = base.select("vec", square.alias("square")).groupBy(octave.alias("octave")).agg(
        F.max("square").alias("longest"), F.count("*").alias("n"), F.first(F.size("vec")).alias("dim"))
    lengths = sorted(lengths.collect(), key=lambda r: -r.octave)
    top = lengths[0].octave if lengths else 0
    dim = lengths[0].dim if lengths else 1
    total = sum(r.n for r in lengths)
    octaves = sorted({min(top - r.octave, RANGES - 1) for r in lengths})
    longest = np.array([max(r.longest for r in lengths if min(top - r.octave, RANGES - 1) == o) for o in octaves])
    place_of = np.zeros(RANGES, np.int64)
    place_of[octaves] = np.arange(len(octaves))

    def keys(it):
        for b in it:
            if not b.num_rows:
                continue
            v = _matrix(b.column(1), dim)
            at = place_of[np.minimum(b.column(3).to_numpy(), RANGES - 1)]
            square = (v * v).sum(axis=1)
            bound = longest[at]
            data = np.c_[v / np.sqrt(bound)[:, None], np.sqrt(np.maximum(0, 1 - square / bound))]
            asks = b.column(2).to_numpy(zero_copy_only=False)
            ask = np.c_[v / np.sqrt(square)[:, None], np.zeros(len(v))][asks]
            gid = b.column(0).to_numpy()
            for c in range(curves):
                of_data, of_ask = curve_keys(data, c, seed), curve_keys(ask, c, seed)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in ((at * curves + c).astype(np.int32), *of_data, gid, np.zeros(len(gid), bool))],
                    names=order)
                for r in range(len(longest) if len(ask) else 0):
                    slot = np.full(len(ask), r * curves + c, np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in (slot, *of_ask, gid[asks], np.ones(len(ask), bool))], names=order)

    order = ["slot", *(f"key{w}" for w in range(WORDS)), "gid", "query"]
    made = (base.select("gid", "vec", "asks", square.alias("square"))
            .select("gid", "vec", "asks", (F.lit(top) - octave).alias("octave")))
    made = made.repartition(tasks, "gid").transform(mapped, keys, ", ".join(
        ["slot int", *(f"key{w} long" for w in range(WORDS)), "gid long", "query boolean"]))

    def number(it):
        # entries of the same slot before the row, in its partition
        part, slot, seen = TaskContext.get().partitionId(), None, 0
        for b in it:
            if not b.num_rows:
                continue
            at, query = b.column(0).to_numpy(), b.column(2).to_numpy(zero_copy_only=False)
            before = np.cumsum(~query) - ~query
            begin = np.r_[0, np.flatnonzero(np.diff(at)) + 1]
            base_of = np.repeat(before[begin], np.diff(np.r_[begin, len(at)]))
            inside = before - base_of
            if at[0] == slot:
                inside[at == slot] += seen
            slot, seen = at[-1], int(inside[-1]) + int(not query[-1])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(np.full(len(at), part, np.int32)), pa.array(inside)],
                names=["slot", "gid", "query", "part", "inside"])

    ranked = cut_lineage(made.repartitionByRange(tasks, *order).sortWithinPartitions(*order).select("slot", "gid", "query")
                         .transform(mapped, number, "slot int, gid long, query boolean, part int, inside long"), "ann-order")
    counts = ranked.groupBy("slot", "part").agg(F.sum((~F.col("query")).cast("long")).alias("n")).collect()
    totals, offsets = Counter(), []
    for r in sorted(counts, key=lambda r: (r.slot, r.part)):
        offsets.append((r.slot, r.part, totals[r.slot]))
        totals[r.slot] += r.n
    offsets = spark.createDataFrame([(*o, totals[o[0]]) for o in offsets], "slot int, part int, before long, entries long")
    # a query's place is the number of entries before it
    placed = ranked.join(F.broadcast(offsets), ["slot", "part"]).select(
        "slot", "gid", "query", (F.col("before") + F.col("inside")).alias("pos"), "entries")
    window = window_needed(base, placed, k, curves, sample, recall, seed)
    used = curves
    if curves * window > total:
        window, used = total, 1
        placed = placed.where(F.col("slot") % curves == 0)
    window = max(window, block)
    # blocks as long as half a window, within what a task holds and as many as the tasks
    cut = max(block, min(window // 2, (1 << 22) // dim, used * total // (4 * tasks)))
    first = F.greatest(F.floor((F.col("pos") - window) / cut), F.lit(0))
    last = F.least(F.floor((F.col("pos") + window - 1) / cut), F.floor((F.col("entries") - 1) / cut))
    near = F.when(F.col("query"), F.sequence(first, F.greatest(first, last))).otherwise(F.array(F.floor(F.col("pos") / cut)))
    visits = (placed.select("gid", "query", "slot", F.explode(near).alias("block"))
              .select("gid", "query", F.shiftleft(F.col("slot").cast("long"), 40).bitwiseOR(F.col("block")).alias("block"))
              .groupBy("gid").agg(F.collect_list(F.struct("block", "query")).alias("to")))
    sent = (base.select("gid", "vec").join(visits, "gid").select("gid", "vec", F.explode("to").alias("to"))
            .select("to.block", "to.query", "gid", "vec").repartition(tasks, "block")
            .sortWithinPartitions("block", "query"))

    def blocks(it):
        # a block's entries come before its queries
        held, data, now = [], None, None
        for b in it:
            if not b.num_rows:
                continue
            at, query, gid = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            v = _matrix(b.column(3), dim)
            cuts = np.r_[0, np.flatnonzero((np.diff(at) != 0) | (query[1:] != query[:-1])) + 1, len(at)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if at[lo] != now:
                    held, data, now = [], None, at[lo]
                if not query[lo]:
                    held.append((gid[lo:hi], v[lo:hi]))
                    continue
                if data is None and held:
                    data, held = [np.concatenate(x) for x in zip(*held)], []
                if data is not None:
                    got = best_of(v[lo:hi], gid[lo:hi], data[1], data[0], k + 1)
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in got], names=["ask", "gid", "score"])

    found = sent.transform(mapped, blocks, "ask long, gid long, score double").groupBy("ask", "gid").agg(
        F.max("score").alias("score"))
    best = Window.partitionBy("ask").orderBy(F.desc("score"), "gid")
    top = found.withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= k + 1)
    ids = base.select("gid", "ids")
    items = top.join(ids, "gid").select("ask", "score", F.explode("ids").alias("vec_id"))
    by_id = Window.partitionBy("ask").orderBy(F.desc("score"), "vec_id")
    # k + 1 items answer every query with this vector: each leaves itself out
    lists = (items.withColumn("rn", F.row_number().over(by_id)).where(F.col("rn") <= k + 1)
             .groupBy("ask").agg(F.sort_array(F.collect_list(F.struct("rn", "vec_id", "score"))).alias("items")))
    asks = _asking(vectors, base, every, id_col, vec_col)
    mine = asks.join(lists, "ask").select(
        "query_id", F.slice(F.filter("items", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("items"))
    return mine.select("query_id", F.posexplode("items").alias("p", "x")).select(
        "query_id", (F.col("p") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))


def _asking(vectors, base, every, id_col, vec_col):
    """(query_id, ask): the query rows and the entry of their vector."""
    q = vectors.select(F.col(id_col).cast("long").alias("query_id"), F.col(vec_col).alias("vec")).where(
        F.col("query_id") % every == 0).distinct()
    return q.join(base.where("asks").select("vec", F.col("gid").alias("ask")), "vec").select("query_id", "ask")
