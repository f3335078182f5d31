"""Profiling: numeric summary, class distribution, correlation, table stats."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orrery.operators.binned import sums
from orrery.operators.clean import numeric_columns
from orrery.operators.quantiles import exact_quantiles

SUMMARY_PROBS = (0.25, 0.5, 0.75)


def describe(df: DataFrame, cols: Sequence[str] | None = None, digits: int | None = 6) -> DataFrame:
    """count, mean, sample std, min, interpolated quartiles, max per numeric column.

    One aggregate pass for the moments plus the bracketed exact quantiles;
    ``df.summary()`` is not used (approximate quartiles, string-typed)."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    aggs = []
    for j, c in enumerate(cols):
        v = F.col(f"`{c}`").cast("double")
        aggs += [F.count(v).alias(f"n{j}"), F.avg(v).alias(f"a{j}"), F.stddev_samp(v).alias(f"s{j}"),
                 F.min(v).alias(f"lo{j}"), F.max(v).alias(f"hi{j}")]
    q = exact_quantiles(df, cols, SUMMARY_PROBS)
    r = (lambda x: F.round(x, digits)) if digits is not None else (lambda x: x)
    qv = lambda c, p: F.lit(q[(c, p)]).cast("double")
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"n{j}").alias("count"),
                     r(F.col(f"a{j}")).alias("mean"), r(F.col(f"s{j}")).alias("std"),
                     r(F.col(f"lo{j}")).alias("min"), r(qv(c, 0.25)).alias("q25"),
                     r(qv(c, 0.5)).alias("q50"), r(qv(c, 0.75)).alias("q75"),
                     r(F.col(f"hi{j}")).alias("max"))
            for j, c in enumerate(cols)]
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("s")).select("s.*")


def class_distribution(df: DataFrame, target: str = "class", digits: int = 6) -> DataFrame:
    """(target, n, share). Counts are map-side combined; the share divides by
    the total over the (one row per class) count table."""
    counts = df.groupBy(target).agg(F.count("*").alias("n"))
    return counts.select(target, "n", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()),
                                               digits).alias("share"))


MAX_COLUMNS = 1_000  # of a correlation matrix: its sums come to the driver


def correlation_matrix(df: DataFrame, cols: Sequence[str] | None = None,
                       digits: int | None = 6) -> DataFrame:
    """Long Pearson matrix (col_a, col_b, corr) in two passes: means, then one
    product of the shifted rows with themselves and with the mask of what is
    present, in blocks of rows (shifting avoids the cancellation of raw sums).
    Pairwise-complete like pandas: each pair has the count and the sums of the
    rows where both are present. A constant column gives NULL (pandas: NaN)."""
    spark = df.sparkSession
    cols = list(cols) if cols is not None else numeric_columns(df)
    if len(cols) > MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} columns")
    schema = "col_a string, col_b string, corr double"
    if not cols:
        return spark.createDataFrame([], schema)
    src = df.select(*[F.col(f"`{c}`").cast("double").alias(f"v{j}") for j, c in enumerate(cols)])
    first = src.agg(*[F.avg(c) for c in src.columns]).first()
    mean, p = np.array([m or 0.0 for m in first], np.float64), len(cols)

    def of_task(batches):
        total = np.zeros((4, p, p))
        for b in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in b.columns], 1)
            gone = np.stack([c.is_null().to_numpy(zero_copy_only=False) for c in b.columns], 1)
            x = np.where(gone, 0.0, x - mean)
            here = (~gone).astype(np.float64)
            for k, (a, c) in enumerate(((here, here), (x, here), (x * x, here), (x, x))):
                total[k] += a.T @ c
        return {0: total}

    got = sums(src, of_task, reader=lambda it, extra: it, size=32 * p * p)
    n, s, q, c = got[0].reshape(4, p, p) if got else np.zeros((4, p, p))
    with np.errstate(divide="ignore", invalid="ignore"):
        var = q - s * s / n  # of column a over the rows that have b too
        corr = (c - s * s.T / n) / np.sqrt(var * var.T)
        varies = var > 1e-24 * n * (mean * mean)[:, None]  # else rounding is all there is
        known = (n > 1) & varies & varies.T
    rows = [(a, b, float(corr[i, j]) if known[i, j] else None) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    out = spark.createDataFrame(rows, schema)
    return out if digits is None else out.withColumn("corr", F.round("corr", digits))


def target_correlation(df: DataFrame, target: str = "class",
                       cols: Sequence[str] | None = None, digits: int | None = 6) -> DataFrame:
    """Correlation of every numeric feature with the (encoded) target, sorted."""
    cols = list(cols) if cols is not None else [c for c in numeric_columns(df) if c != target]
    m = correlation_matrix(df.select(*[f"`{c}`" for c in cols], target), cols + [target], digits)
    return (m.where((F.col("col_b") == target) & (F.col("col_a") != target))
             .select(F.col("col_a").alias("column_name"), F.col("corr"))
             .orderBy(F.col("corr").asc_nulls_last(), "column_name"))


def table_stats(df: DataFrame, flag: str = "is_processed", target: str = "class",
                split: str = "data_split") -> DataFrame:
    """COUNT(*), processed rows, distinct classes, distinct splits."""
    return df.agg(F.count("*").alias("total_records"),
                  F.sum(F.when(F.col(flag), 1).otherwise(0)).cast("long").alias("processed_records"),
                  F.countDistinct(target).alias("unique_classes"),
                  F.countDistinct(split).alias("data_splits"))


def table_info(df: DataFrame) -> DataFrame:
    """(column_name, ordinal, data_type, n_rows): the schema as rows, with the
    row count from one aggregate (shape, columns and dtypes of the EDA)."""
    cols = [F.struct(F.lit(f.name).alias("column_name"), F.lit(j + 1).alias("ordinal"),
                     F.lit(f.dataType.simpleString()).alias("data_type"))
            for j, f in enumerate(df.schema.fields)]
    return (df.agg(F.count("*").alias("n_rows"))
              .select(F.explode(F.array(*cols)).alias("s"), "n_rows").select("s.*", "n_rows"))


# Spark reads COUNT, MIN and MAX from parquet footers only through this reader
_FOOTERS = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}
_RANGED = ("tinyint", "smallint", "int", "bigint", "float", "double", "date")


def footer_plan(spark: SparkSession, paths: Sequence[str], ranges: bool = False) -> DataFrame:
    """One row from the files' footers: ``rows`` and the present values
    ``n{j}`` of each column j, or with ``ranges`` the least and greatest
    number or date ``lo{j}`` and ``hi{j}``."""
    reader = spark.newSession()
    for key, value in _FOOTERS.items():
        reader.conf.set(key, value)
    df = reader.read.parquet(*paths)
    if ranges:
        return df.agg(F.count("*").alias("rows"), *_range_aggs(df))
    return df.agg(F.count("*").alias("rows"), *[F.count(F.col(f"`{c}`")).alias(f"n{j}") for j, c in enumerate(df.columns)])


def _range_aggs(df: DataFrame) -> list:
    cols = [(j, F.col(f"`{f.name}`")) for j, f in enumerate(df.schema.fields) if f.dataType.simpleString() in _RANGED]
    return [x for j, c in cols for x in (F.min(c).alias(f"lo{j}"), F.max(c).alias(f"hi{j}"))]


def stored_profile(spark: SparkSession, paths: Sequence[str], nan: bool = True) -> DataFrame:
    """(column_name, ordinal, data_type, n_rows, n_missing, low, high) of the
    parquet files at ``paths`` from their footers: no column chunk is read for
    rows and nulls. Footers don't tell NaN from other numbers: with ``nan`` the
    fractional columns, and only they, are scanned for it (it counts as missing
    and is no part of a range). Ranges are those of numbers, as doubles, else
    NULL; they too are scanned where a file has none in its footer (all values
    NULL or some NaN)."""
    got = footer_plan(spark, paths).first().asDict()
    df = spark.read.parquet(*paths)
    fields = df.schema.fields
    fractional = [(j, f.name) for j, f in enumerate(fields) if f.dataType.simpleString() in ("float", "double")]
    if nan and fractional:
        got |= df.agg(*[F.count(F.nanvl(F.col(f"`{c}`"), F.lit(None))).alias(f"n{j}") for j, c in fractional]).first().asDict()
    try:
        got |= footer_plan(spark, paths, ranges=True).first().asDict()
    except Exception as e:
        if "No min/max found" not in str(e):
            raise
        is_number = {c for _, c in fractional}
        ranged = df.select(*[F.nanvl(F.col(f"`{c}`"), F.lit(None)).alias(c) if c in is_number else F.col(f"`{c}`")
                             for c in df.columns])
        got |= ranged.agg(F.count("*").alias("rows"), *_range_aggs(ranged)).first().asDict()
    number = lambda x: float(x) if isinstance(x, (int, float)) else None
    rows = [(f.name, j + 1, f.dataType.simpleString(), got["rows"], got["rows"] - got[f"n{j}"],
             number(got.get(f"lo{j}")), number(got.get(f"hi{j}"))) for j, f in enumerate(fields)]
    return spark.createDataFrame(
        rows, "column_name string, ordinal int, data_type string, n_rows long, n_missing long, low double, high double")
