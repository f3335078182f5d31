"""Query registry: key -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orrery.plans.catalog import QUERIES as _CATALOG

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = dict(_CATALOG)
