"""Feature derivation, selection, target encoding and contract conformance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orrery.functions.columns import DEFAULT_BANDS, DEFAULT_CLASS_MAP, default_encode, map_encode

# Identifier/positional columns the notebook drops before modelling.
ID_COLUMNS = ["obj_ID", "alpha", "delta", "run_ID", "rerun_ID", "cam_col", "field_ID", "fiber_ID"]

MAX_CLASSES = 100_000


def color_indices(df: DataFrame, bands: Sequence[str] = DEFAULT_BANDS,
                  suffix: str = "") -> DataFrame:
    """Add (or recompute) adjacent-band differences u_g, g_r, ... when every band exists."""
    if not all(b in df.columns for b in bands):
        return df
    return df.withColumns({f"{a}_{b}{suffix}": F.col(a) - F.col(b)
                           for a, b in zip(bands[:-1], bands[1:])})


def feature_select(df: DataFrame, drop: Sequence[str] = ID_COLUMNS) -> DataFrame:
    """Drop identifier columns; names are matched case-insensitively."""
    lower = {d.lower() for d in drop}
    return df.drop(*[c for c in df.columns if c.lower() in lower])


def encode_map(df: DataFrame, target: str = "class",
               mapping: Mapping[str, int] = DEFAULT_CLASS_MAP) -> DataFrame:
    return df.withColumn(target, map_encode(target, mapping))


def encode_default(df: DataFrame, target: str = "class") -> DataFrame:
    return df.withColumn(target, default_encode(target))


def class_codes(df: DataFrame, target: str = "class",
                max_classes: int = MAX_CLASSES) -> DataFrame:
    """(value, code) with codes 0..k-1 in sorted value order, NULL excluded.

    The distinct set is map-side reduced; its size is checked before it is
    ranked (a single small window) and broadcast."""
    distinct = df.select(F.col(target).alias("value")).where(F.col("value").isNotNull()).distinct()
    k = distinct.count()
    if k > max_classes:
        raise ValueError(f"{target} has {k} distinct values (> {max_classes}); not a class label")
    return distinct.withColumn("code", (F.row_number().over(Window.orderBy("value")) - 1).cast("int"))


def encode_auto(df: DataFrame, target: str = "class") -> DataFrame:
    codes = F.broadcast(class_codes(df, target))
    cols = [F.col("c.code").alias(target) if c == target else F.col(f"d.`{c}`") for c in df.columns]
    return (df.alias("d").join(codes.alias("c"), F.col(f"d.`{target}`") == F.col("c.value"), "left")
              .select(*cols))


def prepare_ingest(df: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Rename raw columns to table names and add the processing flags."""
    renames = {"delta": "delta_coord"} if renames is None else renames
    out = df.withColumnsRenamed({k: v for k, v in renames.items() if k in df.columns})
    return out.withColumns({"is_processed": F.lit(False),
                            "data_split": F.lit(None).cast("string")})


def conform(df: DataFrame, feature_names: Sequence[str], on_missing: str = "error",
            keep: Sequence[str] = ()) -> DataFrame:
    """Reorder to the feature contract, drop extras; a missing feature is an
    error by default (a silent 0 hides name drift), or 0.0 with
    ``on_missing="zero"``. ``keep`` columns (keys) are carried in front."""
    missing = [c for c in feature_names if c not in df.columns]
    if missing and on_missing == "error":
        raise ValueError(f"missing features: {missing}")
    sel = [F.col(f"`{c}`") for c in keep]
    sel += [F.col(f"`{c}`").cast("double").alias(c) if c in df.columns
            else F.lit(0.0).alias(c) for c in feature_names]
    return df.select(*sel)
