"""Composed preparation flow (load -> clean -> features -> encode -> split),
declared as one lazy plan; the only actions are the small aggregates that
produce imputation medians and split cutoffs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.functions.columns import DEFAULT_CLASS_MAP
from orrery.operators.clean import clean, nan_to_null
from orrery.operators.features import color_indices, encode_map
from orrery.operators.sampling import stratified_split
from orrery.sources.observations import BANDS, KEY, TARGET, observations


def cleaned_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(nan_to_null(observations(spark, sf_dir)), target=TARGET)


def featured_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return color_indices(cleaned_observations(spark, sf_dir), BANDS)


def encoded_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_map(featured_observations(spark, sf_dir), TARGET, DEFAULT_CLASS_MAP)


def split_observations(spark: SparkSession, sf_dir: str, test_size: float = 0.2,
                       seed: int = 42) -> DataFrame:
    return stratified_split(encoded_observations(spark, sf_dir), TARGET, [KEY],
                            test_size=test_size, seed=seed)


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: rows per (encoded class, split) after the whole preparation."""
    return (split_observations(spark, sf_dir)
            .groupBy(TARGET, "data_split").agg(F.count("*").alias("n_rows")))
