"""Deterministic, partition-independent splits.

Every random choice is a function of (row key, seed) through md5, so results
do not depend on partitioning or task retries, and DuckDB can reproduce them.

``select_first_per_group`` is the scalable core of the exact stratified split:
instead of one ``row_number`` window per class (a class holding a third of
the rows would be a third of the table in one task) rows are counted per
(group, 16-bit hash bucket), the cutoff bucket of each group is found on that
small table, and only the keys inside the cutoff buckets (about 1/65536 of a
group) are ranked. That gives one cutoff row per group; the rows themselves are
compared with it where they are, in one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.functions.columns import hash_unit, hex_prefix_int, key_hash
from orrery.session import cut_lineage

BUCKET_HEX = 4                      # 16-bit buckets
MAX_GROUPS = 100_000


def select_first_per_group(df: DataFrame, group: str, quotas,
                           key_cols: Sequence[str], seed: int | str,
                           flag: str = "_selected") -> DataFrame:
    """Flag the first ``quota`` rows of each group in md5(key:seed) order
    (ties, which need an md5 collision or a repeated key, by a hash of the
    whole row; rows that are equal in every column go together).

    ``quotas``: a DataFrame (group, quota) - groups missing from it get quota
    0 - or a function from the per-group counts (group, n) to such a
    DataFrame, which then costs no extra scan of ``df``. At most MAX_GROUPS
    groups: one cutoff row for each is collected and broadcast."""
    h = key_hash(key_cols, seed)
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    order = F.struct(h.alias("h"), row_hash.alias("r"))
    bucket = hex_prefix_int(h, BUCKET_HEX).cast("int")
    keys = df.select(F.col(f"`{group}`").alias("g"), bucket.alias("b"), order.alias("o"))
    w = Window.partitionBy("g").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    counts = cut_lineage(keys.groupBy("g", "b").agg(F.count("*").alias("cnt")), "split-counts")
    if callable(quotas):
        quotas = quotas(counts.groupBy(F.col("g").alias(group)).agg(F.sum("cnt").alias("n")))
    quotas = quotas.select(F.col(group).alias("qg"), F.col("quota").alias("q"))
    per_bucket = (counts.withColumn("cum", F.sum("cnt").over(w))
                  .join(quotas, F.col("g").eqNullSafe(F.col("qg")), "left")
                  .withColumn("q", F.coalesce("q", F.lit(0))))
    # the bucket in which a group's quota is reached, and how many of its rows are needed
    cut = (per_bucket.where(F.col("cum") >= F.col("q")).groupBy("g")
           .agg(F.min(F.struct("b", (F.col("q") - F.col("cum") + F.col("cnt")).alias("need"))).alias("m"))
           .select("g", F.col("m.b").alias("cut"), F.col("m.need").alias("need")).limit(MAX_GROUPS + 1))
    schema = cut.schema
    rows = cut.collect()
    if len(rows) > MAX_GROUPS:
        raise ValueError(f"{group} has more than {MAX_GROUPS} groups")
    spark = df.sparkSession
    cut = F.broadcast(spark.createDataFrame(rows, schema).withColumnRenamed("g", "cg"))
    inside = keys.join(cut, F.col("g").eqNullSafe(F.col("cg")) & (F.col("b") == F.col("cut")))
    rank = Window.partitionBy("g").orderBy("o")
    last = (inside.withColumn("rn", F.row_number().over(rank)).where(F.col("rn") <= F.col("need"))
            .groupBy("g").agg(F.max("o").alias("last")))
    last_rows = {r.g: r["last"] for r in last.collect()}
    ends = spark.createDataFrame(
        [(r.g, r.cut, *(last_rows.get(r.g) or (None, None))) for r in rows],
        T.StructType([T.StructField("_cg", schema["g"].dataType), T.StructField("_cut", T.IntegerType()),
                      T.StructField("_h", T.StringType()), T.StructField("_r", T.LongType())]))
    joined = df.join(F.broadcast(ends), F.col(f"`{group}`").eqNullSafe(F.col("_cg")), "left")
    # a group whose quota exceeds its size has no cutoff: all of it is selected
    upto = (bucket < F.col("_cut")) | ((bucket == F.col("_cut")) & F.coalesce(
        (h < F.col("_h")) | ((h == F.col("_h")) & (row_hash <= F.col("_r"))), F.lit(False)))
    return (joined.withColumn(flag, F.col("_cut").isNull() | upto)
            .select(*[F.col(f"`{c}`") for c in df.columns], flag))


def stratified_allocation(df: DataFrame, target: str, test_size: float) -> DataFrame:
    """(target, n, quota): n_test = ceil(N * f); per class floor(n_test*n_c/N),
    the leftover units go to the largest remainders (ties: class value)."""
    return allocation_from_counts(df.groupBy(target).agg(F.count("*").alias("n")), target, test_size)


def allocation_from_counts(counts: DataFrame, target: str, test_size: float) -> DataFrame:
    """The allocation on a (target, n) table of class counts (k rows)."""
    tot = Window.partitionBy()
    alloc = (counts.withColumn("total", F.sum("n").over(tot))
                   .withColumn("n_test", F.ceil(F.col("total") * F.lit(float(test_size))).cast("long"))
                   .withColumn("fl", F.floor(F.col("n_test") * F.col("n") / F.col("total")).cast("long"))
                   .withColumn("rem", (F.col("n_test") * F.col("n")) % F.col("total"))
                   .withColumn("left", F.col("n_test") - F.sum("fl").over(tot))
                   .withColumn("rk", F.row_number().over(Window.orderBy(F.desc("rem"), F.col(target)))))
    return alloc.select(target, "n", (F.col("fl") + F.when(F.col("rk") <= F.col("left"), 1)
                                      .otherwise(0)).alias("quota"))


def stratified_split(df: DataFrame, target: str = "class", key_cols: Sequence[str] = ("obj_id",),
                     test_size: float = 0.2, seed: int = 42,
                     split_col: str = "data_split") -> DataFrame:
    """Exact stratified TEST/TRAIN assignment (per-class counts as the
    largest-remainder allocation; membership by md5 order inside a class)."""
    flagged = select_first_per_group(
        df, target, lambda counts: allocation_from_counts(counts, target, test_size),
        list(key_cols), seed)
    return (flagged.withColumn(split_col, F.when(F.col("_selected"), "TEST").otherwise("TRAIN"))
                   .drop("_selected"))


def random_split(df: DataFrame, key_cols: Sequence[str] = ("obj_id",), test_size: float = 0.33,
                 seed: int = 42, split_col: str = "data_split") -> DataFrame:
    """Unstratified split by a hash threshold on (key, seed)."""
    u = hash_unit(key_hash(key_cols, seed))
    return df.withColumn(split_col, F.when(u < F.lit(float(test_size)), "TEST").otherwise("TRAIN"))


def hash_folds(df: DataFrame, k: int = 3, key_cols: Sequence[str] = ("obj_id",),
               seed: int = 42, fold_col: str = "fold") -> DataFrame:
    """Fold number 0..k-1 from md5(key:seed) (first 32 bits mod k)."""
    return df.withColumn(fold_col, (hex_prefix_int(key_hash(key_cols, seed), 8) % k).cast("int"))
