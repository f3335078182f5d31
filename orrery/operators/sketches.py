"""Column statistics that add up: sketches kept with each part of a table.

Every part has, for each column, its rows, nulls and range, a KLL sketch of
its values (quantiles) and an HLL sketch of them (distinct count). Sketches of
parts merge into those of a version, so statistics of an appended table read
the new part only. Sketches are Spark's own (Apache DataSketches); quantiles
have a rank error of about 2.3 / k^0.9 of the rows, distinct counts a relative
error of about 0.83 / sqrt(2^lg_k), both whatever the number of parts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.operators.quantiles import _counts_at
from orrery.sources.tables import Tables

K = 800
LG_K = 14
QUARTILES = (0.25, 0.5, 0.75)
SCHEMA = ("column_name string, n_rows long, n_present long, low double, high double, quantiles binary, distinct binary")


def rank_error(k: int = K) -> float:
    """Bound on a quantile's rank error, as a share of the values (99 % of sketches)."""
    return 2.296 / k**0.9021


def distinct_error(lg_k: int = LG_K) -> float:
    """Three standard deviations of a distinct count, as a share of it."""
    return 3 * 0.8326 / 2 ** (lg_k / 2)


def part_sketches(df: DataFrame, cols: Sequence[str], k: int = K, lg_k: int = LG_K) -> DataFrame:
    """A row of SCHEMA for each numeric column of ``cols``, in one pass. NaN
    counts as missing; a column without values has empty sketches."""
    aggs, rows = [F.count("*").alias("n")], []
    for j, c in enumerate(cols):
        v = F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None))
        aggs += [F.count(v).alias(f"n{j}"), F.min(v).alias(f"lo{j}"), F.max(v).alias(f"hi{j}"),
                 F.kll_sketch_agg_double(v, k).alias(f"q{j}"), F.hll_sketch_agg(v.cast("string"), lg_k).alias(f"d{j}")]
        rows.append(F.struct(F.lit(c).alias("column_name"), F.col("n").alias("n_rows"), F.col(f"n{j}").alias("n_present"),
                             F.col(f"lo{j}").alias("low"), F.col(f"hi{j}").alias("high"),
                             F.col(f"q{j}").alias("quantiles"), F.col(f"d{j}").alias("distinct")))
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("s")).select("s.*")


def merged(parts: DataFrame) -> DataFrame:
    """Rows of SCHEMA of several parts as one row a column. A column that some
    parts lack has the rows of all parts, and is missing in those."""
    per = parts.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_present").alias("n_present"), F.min("low").alias("low"),
        F.max("high").alias("high"), F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.hll_union_agg("distinct").alias("distinct"))
    return per.select(*[c.split()[0] for c in SCHEMA.split(", ")])


def statistics(sketches: DataFrame, probs: Sequence[float] = QUARTILES) -> DataFrame:
    """(column_name, n_rows, n_missing, low, high, quantiles, distinct):
    quantiles at ``probs``, NULL without values; distinct is an estimate."""
    some = F.col("n_present") > 0
    at = F.array(*[F.lit(float(p)) for p in probs])
    return sketches.select(
        "column_name", "n_rows", (F.col("n_rows") - F.col("n_present")).alias("n_missing"), "low", "high",
        F.when(some, F.kll_sketch_get_quantile_double("quantiles", at)).alias("quantiles"),
        F.when(some, F.hll_sketch_estimate("distinct")).otherwise(F.lit(0)).cast("long").alias("distinct"))


class Sketches:
    """Sketches beside the parts of stored tables."""

    def __init__(self, tables: Tables, cols: Sequence[str], k: int = K, lg_k: int = LG_K):
        self.tables, self.cols, self.k, self.lg_k = tables, list(cols), k, lg_k

    def _path(self, part: str) -> str:
        base, name = part.replace("/data/", "/sketches/").rsplit("/", 1)
        return f"{base}/{name}/k={self.k}-{self.lg_k}"

    def refresh(self, name: str, version: int | None = None) -> int:
        """Sketch the parts of a version that have none yet; how many were read."""
        t, read = self.tables, 0
        for part in t.paths(name, version):
            if not t.has(f"{self._path(part)}/_SUCCESS"):
                df = t.spark.read.parquet(part)
                part_sketches(df, [c for c in self.cols if c in df.columns], self.k, self.lg_k) \
                    .coalesce(1).write.mode("overwrite").parquet(self._path(part))
                read += 1
        return read

    def of(self, name: str, version: int | None = None) -> DataFrame:
        """Merged sketches of a version; only parts without sketches are read."""
        self.refresh(name, version)
        t = self.tables
        return merged(t.spark.read.schema(SCHEMA).parquet(*[self._path(p) for p in t.paths(name, version)]))


def within_bounds(df: DataFrame, stats: DataFrame, probs: Sequence[float] = QUARTILES, k: int = K,
                  lg_k: int = LG_K) -> DataFrame:
    """(column_name, quantiles_hold, distinct_holds): estimates checked against
    exact ranks and distinct counts of ``df``, which is read whole."""
    rows = stats.collect()
    cols = [r.column_name for r in rows]
    clean = df.select(*[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)).alias(c) for c in cols])
    less, equal = _counts_at(clean, {r.column_name: sorted(set(r.quantiles)) for r in rows if r.quantiles})
    exact = clean.agg(*[F.count_distinct(c).alias(f"d{j}") for j, c in enumerate(cols)]).first()
    out = []
    for j, r in enumerate(rows):
        n, slack = r.n_rows - r.n_missing, rank_error(k)
        hold = all(less[r.column_name, q] / n - slack <= p <= (less[r.column_name, q] + equal[r.column_name, q]) / n + slack
                   for p, q in zip(probs, r.quantiles or []))
        out.append((r.column_name, hold, abs(r.distinct - exact[j]) <= distinct_error(lg_k) * exact[j]))
    return df.sparkSession.createDataFrame(out, "column_name string, quantiles_hold boolean, distinct_holds boolean")
