"""Audit of the sources of each language: which term counts set a source apart.

Late materialisation: a term travels as a 64-bit digest. The tokenising tasks
write (group, digest, term, counts) once; every shuffle of counts reads only
the fixed-width columns. The smallest and the largest string of each digest
are compared once, and a digest under which they differ is split: its rows
are told apart by their strings from there on, which the others carry as null.
Strings are joined back to the few rows that a report keeps.

Sums over pairs of sources need each kept term of the language, also those
that neither source has. Terms are dealt into chunks, a chunk is a small dense
matrix (term x source), and tiles of sources are compared as arrays; the terms
of a language that a tile of sources doesn't have are added by their number.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orrery.llm.common import batches, mapped, text_bytes
from orrery.session import cut_lineage, ship_package

SCALE = 1_000_000_000  # probabilities are whole numbers of 1/SCALE
PIECE = 4 << 20  # bytes of text counted at once
HELD = 600_000  # terms a task holds before it writes them, at about 300 bytes
TILE = 64  # sources compared at once
CELLS = 100_000  # about so many (source, term) cells in a chunk

KEY = ["lid", "d", "part"]  # a term of a language: digests, and the string where digests collide

# letters A-Z in lower case, other bytes outside a term blank: a byte above
# 127 belongs to a character above 127, so bytes split as characters do
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def _parts(text: bytes) -> Iterator[list[bytes]]:
    """All terms of a text in order, those of a long text in pieces."""
    flat, at = text.translate(_FOLD), 0
    while at < len(flat):
        end = flat.find(b" ", at + PIECE) if at + PIECE < len(flat) else -1
        end = len(flat) if end < 0 else end
        yield flat[at:end].split()
        at = end


def _count(text: bytes) -> Counter:
    """Occurrences of each term."""
    out = Counter()
    for terms in _parts(text):
        out.update(terms)
    return out


def counted(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """(lang, source, term, n, df) of each task: occurrences and documents. A
    task may write a pair of a term and a group more than once. Under the null
    term df counts the group's documents, so that groups without terms occur."""
    src = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in
                        ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))

    def run(it):
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0

        def out():
            for (lang, source), (n, df) in held.items():
                k = len(df)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * k, pa.string()), pa.array([source] * k, pa.string()),
                     pa.array(list(df), pa.binary()).cast(pa.string()),
                     pa.array([n[t] for t in df], pa.int64()), pa.array(list(df.values()), pa.int64())],
                    names=["lang", "source", "term", "n", "df"])
            held.clear()

        for b in batches(it, PIECE, "text"):
            for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), text_bytes(b.column(2))):
                n, df = held.setdefault((lang, source), (Counter(), Counter()))
                size -= len(df)
                # lists and sets are counted in one step, without a dictionary for each text
                one = {None}
                for terms in _parts(text):
                    n.update(terms)
                    one.update(terms)
                df.update(one)
                size += len(df)
            if size > HELD:
                yield from out()
                size = 0
        yield from out()

    return src.transform(mapped, run, "lang string, source string, term string, n long, df long")


def _p(count: str, total: str) -> str:
    """SQL of 1 + floor(SCALE (count + 1) / (total + kinds)). The product may
    pass 64 bits, so it is a decimal; the division is exact."""
    return f"1L + (CAST({count} + 1 AS DECIMAL(19,0)) * {SCALE} DIV CAST({total} + kinds AS DECIMAL(19,0)))"


def _spread(p: str, q: str) -> str:
    """SQL of floor((p - q)^2 / q); below 2^63, as p and q are at most SCALE + 1."""
    return f"({p} - {q}) * ({p} - {q}) DIV {q}"


@dataclass
class Audit:
    """Counts of all kept terms of every language, as written tables.

    ``groups`` (lang, source, lid, gid, at, total, kinds, lang_total, parts):
    ``at`` numbers the sources of a language, ``total`` and ``lang_total`` sum
    the kept counts of the group and the language, ``kinds`` is the number of
    kept terms, ``parts`` that of the chunks they are dealt into.
    ``cells`` (gid, lid, d, part, n, p, q): the kept terms that a group has.
    ``words`` (d, part, term): texts of the terms, repeated."""

    groups: DataFrame
    cells: DataFrame
    words: DataFrame


def audit(docs: DataFrame, min_docs: int = 3, text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source", bits: int = 64) -> Audit:
    """Count the terms of every (lang, source) group of ``docs``; each language
    keeps the terms in at least ``min_docs`` of its rows.

    Null text, language and source are empty strings; rows of equal content
    are documents of their own; other columns aren't read. An empty table gives
    empty tables. ``bits`` shortens the digests, which changes no result."""
    digest = F.xxhash64("term") if bits >= 64 else F.shiftright(F.xxhash64("term"), 64 - bits)
    raw = cut_lineage(counted(docs, text_col, lang_col, source_col).withColumns(
        {"d": digest, "lid": F.xxhash64("lang"), "gid": F.xxhash64("lang", "source")}), "divergence-counted")
    groups = cut_lineage(
        raw.where("term IS NULL").select("lang", "source", "lid", "gid").distinct()
        .withColumn("at", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1),
        "divergence-groups")
    n, n_gid, n_lang, n_lid = groups.agg(F.count("*"), *(F.count_distinct(c) for c in ("gid", "lang", "lid"))).first()
    if n != n_gid or n_lang != n_lid:
        raise RuntimeError("two names of a language or source have one 64-bit digest")
    # the one shuffle with strings: smallest and largest of each digest, one row a task and digest
    rows = raw.where("term IS NOT NULL")
    split = cut_lineage(rows.groupBy("d").agg(F.min("term").alias("lo"), F.max("term").alias("hi"))
                        .where("lo <> hi").select("d", F.lit(True).alias("shared")), "divergence-split")
    words = rows.join(split, "d", "left").withColumn("part", F.when(F.col("shared"), F.col("term")))
    sums = cut_lineage(words.groupBy("gid", *KEY).agg(F.sum("n").alias("n"), F.sum("df").alias("df")),
                       "divergence-sums")
    kept = cut_lineage(sums.groupBy(*KEY).agg(F.sum("df").alias("df"), F.sum("n").alias("lang_n"),
                                              F.count("*").alias("groups"))
                       .where(F.col("df") >= min_docs), "divergence-kept")
    langs = kept.groupBy("lid").agg(
        F.count("*").alias("kinds"), F.sum("lang_n").alias("lang_total"),
        F.ceil(F.sum("groups") / CELLS).cast("int").alias("parts"))
    match = [F.col(f"s.{k}").eqNullSafe(F.col(f"k.{k}")) for k in KEY]
    mine = cut_lineage(sums.alias("s").join(kept.alias("k"), match)
                       .select("s.gid", *(f"s.{k}" for k in KEY), "s.n", "k.lang_n"), "divergence-mine")
    totals = mine.groupBy("gid").agg(F.sum("n").alias("total"))
    groups = cut_lineage(groups.join(totals, "gid", "left").join(langs, "lid", "left")
                         .fillna(0, ["total", "kinds", "lang_total", "parts"]), "divergence-totals")
    cells = (mine.join(groups.select("gid", "total", "kinds", "lang_total"), "gid")
             .select("gid", *KEY, "n", F.expr(_p("n", "total")).alias("p"),
                     F.expr(_p("lang_n", "lang_total")).alias("q")))
    return Audit(groups, cells, words.select("d", "part", "term"))


def pairs(found: Audit) -> DataFrame:
    """(lang, source, item, value): for each two sources of a language the sum
    of floor((p - q)^2 / q) over all kept terms, p that of ``source``, q that
    of ``item``. Zero where no term is kept; sources alone have no row."""
    ship_package(found.cells.sparkSession)
    width = TILE
    # none: p of a kept term that the group doesn't have
    groups = found.groups.withColumns({"none": F.expr(f"IF(kinds > 0, {_p('0', 'total')}, 1)"),
                                       "tile": F.floor(F.col("at") / width)})
    tiles = groups.groupBy("lid").agg(F.max("tile").alias("last"))
    sources = groups.join(tiles, "lid").where("parts > 0").select("gid", "at", "none", "tile", "last", "parts")
    chunk = F.pmod(F.xxhash64("d", "part"), F.col("parts")).cast("int").alias("chunk")
    cells = found.cells.select("gid", *KEY, "p").join(sources, "gid").select(
        "lid", "at", "none", "tile", "last", chunk, "d", "part", "p")
    # each source is told to each chunk of its language, whether it has a term there or not
    told = (groups.join(tiles, "lid").where("parts > 0")
            .select("lid", "at", "none", "tile", "last", F.explode(F.expr("sequence(0, parts - 1)")).alias("chunk"),
                    F.lit(None).cast("long").alias("d"), F.lit(None).cast("string").alias("part"),
                    F.lit(None).cast("long").alias("p")))
    dealt = (cells.unionByName(told)
             .withColumn("mate", F.explode(F.expr("sequence(0L, last)")))
             .withColumns({"ti": F.least("tile", "mate"), "tj": F.greatest("tile", "mate")})
             .drop("tile", "last", "mate"))
    sums = (dealt.groupBy("lid", "ti", "tj", "chunk")
            .applyInPandas(lambda rows: _tile(rows, width), "lid long, a long, b long, value long, seen long")
            .groupBy("lid", "a", "b").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen")))
    one = groups.select("lid", "lang", "source", F.col("at").alias("a"), F.col("none").alias("p"), "kinds")
    other = groups.select("lid", F.col("source").alias("item"), F.col("at").alias("b"), F.col("none").alias("q"))
    return (one.join(other, "lid").where("a <> b").join(sums, ["lid", "a", "b"], "left")
            .select("lang", "source", "item",
                    F.expr(f"coalesce(value, 0L) + (kinds - coalesce(seen, 0L)) * ({_spread('p', 'q')})").alias("value")))


def _tile(rows: pd.DataFrame, width: int) -> pd.DataFrame:
    """Sums over the terms of a chunk that some source of the tile has, for
    each two sources; ``seen`` is the number of those terms."""
    ti, tj = int(rows["ti"].iloc[0]), int(rows["tj"].iloc[0])
    cell = rows["p"].notna().to_numpy()
    at, first, col = np.unique(rows["at"].to_numpy(), return_index=True, return_inverse=True)
    none = rows["none"].to_numpy()[first]
    names = rows.loc[cell, ["d", "part"]]
    term = (names.groupby(["d", "part"], dropna=False, sort=False).ngroup().to_numpy()
            if names["part"].notna().any() else pd.factorize(names["d"])[0])
    order = np.argsort(term, kind="stable")
    term, col, p = term[order], col[cell][order], rows.loc[cell, "p"].to_numpy().astype(np.int64)[order]
    n, k = (int(term[-1]) + 1 if len(term) else 0), len(at)
    value = np.zeros((k, k), np.int64)
    step = max(1, (1 << 20) // (k * k))
    for lo in range(0, n, step):
        hi = min(n, lo + step)
        i, j = np.searchsorted(term, (lo, hi))
        dense = np.tile(none, (hi - lo, 1))
        dense[term[i:j] - lo, col[i:j]] = p[i:j]
        left, right = dense[:, :, None], dense[:, None, :]
        value += ((left - right) ** 2 // right).sum(0)
    home = at // width
    i, j = np.nonzero((np.minimum.outer(home, home) == ti) & (np.maximum.outer(home, home) == tj)
                      & ~np.eye(k, dtype=bool))
    return pd.DataFrame({"lid": rows["lid"].iloc[0], "a": at[i], "b": at[j], "value": value[i, j], "seen": n})


def top_terms(found: Audit, most: int = 200) -> DataFrame:
    """(lang, source, item, value): the ``most`` terms of each group of the
    largest floor((p - q)^2 / q) where p, the group's, is above q, the
    language's; of equal values the smaller term in UTF-8 order."""
    over = (found.cells.where("p > q")
            .select("gid", "d", "part", F.expr(_spread("p", "q")).alias("value")))
    down = Window.partitionBy("gid").orderBy(F.desc("value"))
    # the value of the last rank from counts of equal values, so that texts are only joined to terms that reach it
    steps = (over.groupBy("gid", "value").agg(F.count("*").alias("ties"))
             .withColumn("rank", F.row_number().over(down)).where(F.col("rank") <= most)
             .withColumn("before", F.sum("ties").over(down) - F.col("ties")))
    least = steps.where(F.col("before") < most).groupBy("gid").agg(F.min("value").alias("least"))
    reach = cut_lineage(over.join(least, "gid").where("value >= least").drop("least"), "divergence-reach")
    names = ["d", "part"]
    wanted = reach.select(*names).distinct()
    match = [F.col(f"w.{k}").eqNullSafe(F.col(f"r.{k}")) for k in names]
    texts = (found.words.alias("w").join(wanted.alias("r"), match, "left_semi")
             .groupBy(*names).agg(F.first("term").alias("item")))
    match = [F.col(f"r.{k}").eqNullSafe(F.col(f"t.{k}")) for k in names]
    return (reach.alias("r").join(texts.alias("t"), match).select("r.gid", "r.value", "t.item")
            .withColumn("rank", F.row_number().over(Window.partitionBy("gid").orderBy(F.desc("value"), "item")))
            .where(F.col("rank") <= most)
            .join(found.groups.select("gid", "lang", "source"), "gid").select("lang", "source", "item", "value"))


def report(found: Audit, most: int = 200) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank: the other
    sources of each group's language by divergence, all of them, and the
    ``most`` terms that stand out in the group, both from 1 by falling value
    and rising item."""
    place = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    both = (pairs(found).withColumn("part", F.lit("pair"))
            .unionByName(top_terms(found, most).withColumn("part", F.lit("term"))))
    return both.select("lang", "source", "part", "item", "value", F.row_number().over(place).alias("rank"))
