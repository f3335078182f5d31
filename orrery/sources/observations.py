"""The ``observations`` stand-in catalog, derived from ``lineitem``.

The test data carries no sky-survey table, so a wide catalog with a planted
3-class label is derived column by column from ``lineitem``. The expressions
are plain SQL accepted by both Spark and DuckDB, so the same text defines the
view in the Spark job and in the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed definitions of the stand-in catalog (shared with the DuckDB oracle).
OBSERVATION_COLUMNS: list[str] = [
    "concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_partkey AS STRING), "
    "CAST(l_suppkey AS STRING), CAST(l_linenumber AS STRING)) AS obj_id",
    "CAST(l_partkey % 360 AS DOUBLE) AS alpha",
    "CAST(l_suppkey % 180 AS DOUBLE) - 90.0 AS delta",
    "l_quantity AS u",
    "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice / 1000 END AS g",
    "l_discount * 100 AS r",
    "l_tax * 100 AS i",
    "CAST(l_linenumber AS DOUBLE) AS z",
    "301 AS rerun_id",
    "l_discount * l_tax AS redshift",
    "CAST(l_orderkey % 10000 AS INT) AS plate",
    "CAST(l_suppkey % 1000 AS INT) AS fiber_id",
    "CASE WHEN l_orderkey % 97 = 0 THEN NULL "
    "WHEN l_quantity > 25 AND l_discount > 0.05 THEN 'GALAXY' "
    "WHEN l_extendedprice > 50000 THEN 'STAR' ELSE 'QSO' END AS class",
    "l_orderkey % 3 <> 0 AS is_processed",
]

# Types of the stand-in columns (Spark simple type names).
OBSERVATION_TYPES: dict[str, str] = {
    "obj_id": "string", "alpha": "double", "delta": "double", "u": "double", "g": "double",
    "r": "double", "i": "double", "z": "double", "rerun_id": "int", "redshift": "double",
    "plate": "int", "fiber_id": "int", "class": "string", "is_processed": "boolean",
}
NUMERIC_COLUMNS = [c for c, t in OBSERVATION_TYPES.items() if t in ("double", "int")]

# Columns the stand-in uses for the five photometric bands, in band order.
BANDS = ["u", "g", "r", "i", "z"]
KEY = "obj_id"
TARGET = "class"
CLASS_LABELS = ["GALAXY", "STAR", "QSO"]

OBSERVATIONS_SQL = "SELECT " + ",\n       ".join(OBSERVATION_COLUMNS) + "\nFROM lineitem"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide catalog: one row per lineitem, only the columns it needs are read."""
    return read_table(spark, sf_dir, "lineitem").selectExpr(*OBSERVATION_COLUMNS)


def oracle_cte() -> str:
    """``WITH observations AS (...)`` prefix for DuckDB oracle statements."""
    return f"WITH observations AS ({OBSERVATIONS_SQL})\n"
