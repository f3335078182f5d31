"""Cleaning: NaN -> NULL, missing counts, median imputation, NULL-target drop."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.operators.quantiles import approx_quantiles, exact_quantiles

FRACTIONAL = (T.DoubleType, T.FloatType)
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
           T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC) and f.name not in set(exclude)]


def nan_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Spark keeps NaN distinct from NULL (median over NaN is NaN); the
    reference treats both as missing. Apply once at ingest."""
    frac = {f.name for f in df.schema.fields if isinstance(f.dataType, FRACTIONAL)}
    targets = [c for c in (cols or frac) if c in frac]
    if not targets:
        return df
    return df.withColumns({c: F.when(~F.isnan(F.col(c)), F.col(c)) for c in targets})


def _is_missing(df: DataFrame, c: str):
    dt = df.schema[c].dataType
    m = F.col(f"`{c}`").isNull()
    return m | F.isnan(F.col(f"`{c}`")) if isinstance(dt, FRACTIONAL) else m


def missing_counts(df: DataFrame, total_name: str = "__total__") -> DataFrame:
    """(column_name, ordinal, n_missing) per column plus one total row; one pass."""
    cols = df.columns
    row = df.agg(*[F.count_if(_is_missing(df, c)).alias(f"m{j}") for j, c in enumerate(cols)])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.lit(j).alias("ordinal"),
                      F.col(f"m{j}").alias("n_missing")) for j, c in enumerate(cols)]
    total = F.struct(F.lit(total_name).alias("column_name"), F.lit(len(cols)).alias("ordinal"),
                     sum((F.col(f"m{j}") for j in range(len(cols))), F.lit(0)).alias("n_missing"))
    return row.select(F.explode(F.array(*pairs, total)).alias("s")).select("s.*")


def missing_and_present(df: DataFrame, cols: Sequence[str]) -> tuple[dict, dict]:
    """One pass: ({col: n_missing}, {col: n_present})."""
    if not cols:
        return {}, {}
    row = df.agg(*[F.count_if(_is_missing(df, c)).alias(f"m{j}") for j, c in enumerate(cols)],
                 *[F.count(F.col(f"`{c}`")).alias(f"n{j}") for j, c in enumerate(cols)]).first()
    return ({c: row[f"m{j}"] for j, c in enumerate(cols)},
            {c: row[f"n{j}"] for j, c in enumerate(cols)})


def columns_with_missing(df: DataFrame, cols: Sequence[str]) -> list[str]:
    missing, _ = missing_and_present(df, cols)
    return [c for c in cols if missing[c] > 0]


def impute_median(df: DataFrame, cols: Sequence[str] | None = None,
                  exclude: Sequence[str] = (), exact: bool = True) -> DataFrame:
    """Fill NULLs of each numeric column that has any with its median.

    Integral columns with NULLs become double (as pandas makes them float).
    An all-NULL column stays NULL. ``exact=False`` uses one sketch pass."""
    cols = list(cols) if cols is not None else numeric_columns(df, exclude)
    missing, present = missing_and_present(df, cols)
    todo = [c for c in cols if missing[c] > 0]
    if not todo:
        return df
    q = (exact_quantiles(df, todo, [0.5], counts=present) if exact
         else approx_quantiles(df, todo, [0.5]))
    fills = {}
    for c in todo:
        m = q[(c, 0.5)]
        src = F.col(f"`{c}`").cast("double")
        fills[c] = F.coalesce(src, F.lit(m).cast("double")) if m is not None else src
    return df.withColumns(fills)


def drop_null_target(df: DataFrame, target: str = "class") -> DataFrame:
    return df.dropna(subset=[target]) if target in df.columns else df


def clean(df: DataFrame, target: str = "class", handle_missing: bool = True,
          exact: bool = True) -> DataFrame:
    """Median-impute numeric columns (target excluded), then drop NULL targets,
    in the reference's order: medians include rows whose target is NULL."""
    out = df
    if handle_missing:
        out = impute_median(out, exclude=[target], exact=exact)
    return drop_null_target(out, target)
