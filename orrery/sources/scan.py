"""Typed delimited-file scan with a quarantine for rows that do not parse.

The schema is always explicit (no inference pass over the data, no row cap);
rows that fail to parse keep their raw text in ``_corrupt_record`` instead of
failing the job or silently becoming NULLs. NaN is turned into NULL at ingest
because the reference counts both as missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.operators.clean import nan_to_null

CORRUPT = "_corrupt_record"


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType | str,
                   header: bool = True, sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """Return (good rows, quarantined rows: raw line plus whatever parsed).
    Spark refuses scans that read only the corrupt-record column, so the
    quarantine keeps the data columns too."""
    st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    full = T.StructType(st.fields + [T.StructField(CORRUPT, T.StringType())])
    df = (spark.read.schema(full).option("header", header).option("sep", sep)
               .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
               .csv(path))
    good = nan_to_null(df.where(F.col(CORRUPT).isNull()).drop(CORRUPT))
    bad = df.where(F.col(CORRUPT).isNotNull())
    return good, bad


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.mode("errorifexists").option("header", header).csv(path)
