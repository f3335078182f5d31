"""SimHash near-duplicate detection by deletion-variant signatures.

A fingerprint is cut into two 32-bit segments. Two fingerprints that differ in
at most two bits differ in at most one bit of one segment, so they share one of
the 32 variants of that segment in which one bit is a wildcard. All 64 variants
of each distinct fingerprint are indexed, equal variants are joined, and the
pairs found are verified on all 64 bits.

A variant shared by more than ``crowd`` distinct fingerprints is not joined
with itself. Its fingerprints are indexed a second time under all variants of
the whole fingerprint with two wildcards; at most four fingerprints share one
of those, so each of its groups is a star and no pairs are listed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import batches, components, free_name, mapped, text_bytes
from orrery.session import cut_lineage

BITS = 64
CHUNK = 1 << 15  # shingles whose bits are unpacked at once


def fingerprint(text: bytes, size: int = 3, seed: int = 42) -> int:
    """SimHash of one text: a bit is set if it is set in over half of the
    shingles' hashes, repeats included. No words: zero."""
    words = text.lower().split()  # bytes: A-Z and \\x20\\x09-\\x0D only
    if not words:
        return 0
    flat = b" ".join(words)
    if len(words) <= size:
        return xxhash.xxh64_intdigest(flat, seed)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lens + 1) - lens - 1
    n = len(words) - size + 1
    ends = (starts + lens)[size - 1:].tolist()
    starts = starts[:n].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for i in range(0, n, CHUNK):
        h = np.array([digest(flat[a:b], seed) for a, b in zip(starts[i:i + CHUNK], ends[i:i + CHUNK])],
                     dtype=np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    bits = np.packbits((2 * counts > n).astype(np.uint8), bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, th): the fingerprint as a signed long and a hash of the text.
    Null text: fp zero."""
    src = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    schema = src.select("id", "th").schema.add("fp", "long")

    def run(it):
        for b in batches(it, 8 << 20, "text"):
            fps = np.array([fingerprint(t, size) for t in text_bytes(b.column(2))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(fps.view(np.int64))], names=["id", "th", "fp"])

    return src.transform(mapped, run, schema)


def links(fps: DataFrame, max_bits: int = 2, crowd: int = 32) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` whose transitive
    closure is that of all pairs at ``max_bits`` (0 to 2) or fewer bits."""
    if not 0 <= max_bits <= 2:
        raise ValueError("two segments with one wildcard find pairs at 0 to 2 bits")
    # each row becomes 64: dealt out anew, so that no few tasks make them all
    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    one = fps.select("fp").distinct().repartition(tasks, "fp")
    # bit j as a wildcard; the segment that holds bit j is kept, the other is dropped
    half = F.when(F.col("j") < 32, F.lit(0xFFFFFFFF).cast("long")).otherwise(
        F.expr("shiftleft(4294967295L, 32)"))
    bit = F.expr("shiftleft(1L, j)")
    variants = (one.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))))
                .select("fp", "j", F.col("fp").bitwiseAND(half).bitwiseAND(F.bitwise_not(bit)).alias("seg")))
    keys = variants.groupBy("j", "seg").agg(F.count("*").alias("n")).where("n > 1")
    # merged, whatever Spark sizes them at: it holds 64 rows of an explode for one, and a table for as small as its files
    shared = cut_lineage(variants.join(keys.hint("merge"), ["j", "seg"]), "simhash-variants")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("gp"))) <= max_bits
    plain = shared.where(F.col("n") <= crowd)
    pairs = (plain.join(plain.select("j", "seg", F.col("fp").alias("gp")).hint("merge"), ["j", "seg"])
             .where((F.col("fp") < F.col("gp")) & near)
             .select(F.col("gp").alias("a"), F.col("fp").alias("b")))
    crowded = shared.where(F.col("n") > crowd).select("fp").distinct()
    two = (crowded.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(BITS - 2))))
           .withColumn("k", F.explode(F.expr("sequence(i + 1, 63)")))
           .withColumn("rest", F.col("fp").bitwiseAND(F.bitwise_not(
               F.expr("shiftleft(1L, i)").bitwiseOR(F.expr("shiftleft(1L, k)")))))
           .groupBy("i", "k", "rest").agg(F.collect_set("fp").alias("all")).where(F.size("all") > 1))
    if max_bits == 2:
        stars = two.select(F.explode("all").alias("a"), F.array_min("all").alias("b")).where("a > b")
    else:  # at most four members: their pairs are at most six
        stars = (two.withColumn("fp", F.explode("all")).withColumn("gp", F.explode("all"))
                 .where((F.col("fp") < F.col("gp")) & near).select(F.col("gp").alias("a"), F.col("fp").alias("b")))
    return pairs.unionByName(stars).distinct()


def groups(docs: DataFrame, size: int = 3, max_bits: int = 2, crowd: int = 32, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id, th, fp, root, component_id) for every row of ``docs``; ``root``
    names the row's group."""
    rows = cut_lineage(fingerprints(docs, size, id_col, text_col), "simhash-rows")
    least = cut_lineage(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-least")
    roots = components(links(least, max_bits, crowd))
    linked = (least.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
              .withColumn("root", F.coalesce("root", "fp")))
    lowest = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(linked.join(lowest, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(docs: DataFrame, size: int = 3, max_bits: int = 2, crowd: int = 32,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (16 hex digits),
    component_id (smallest id that is reachable over links).

    Null, empty and word-free texts have fingerprint zero and are linked like
    any other. A null id keeps its row and is the component's id only where
    the component has no other. Repeated ids keep their rows. An empty table
    gives an empty result; other columns are not read."""
    return groups(docs, size, max_bits, crowd, id_col, text_col).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), BITS // 4, "0")).alias("fingerprint"),
        "component_id")


def drop_near_duplicates(docs: DataFrame, size: int = 3, max_bits: int = 2, crowd: int = 32,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near duplicates: that of the
    smallest id (a null id last; of rows with that id the one whose text has
    the smallest hash; of equal rows any one). Columns and nulls as before."""
    found = groups(docs, size, max_bits, crowd, id_col, text_col)
    stay = (found.where(F.col("id").eqNullSafe(F.col("component_id")))
            .groupBy("root").agg(F.min(F.struct("th", "id")).alias("stay"))
            .select(F.col("stay.id").alias("stay_id"), F.col("stay.th").alias("stay_th")))
    th = free_name(docs.columns, "th")
    src = docs.withColumn(th, F.xxhash64(text_col))
    match = src[id_col].eqNullSafe(stay["stay_id"]) & (src[th] == stay["stay_th"])
    return src.join(stay, match, "left_semi").dropDuplicates([id_col, th]).drop(th)
