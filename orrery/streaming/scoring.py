"""Scoring arriving rows: the batch ``score`` function applied to a
streaming DataFrame (stateless, so no watermark or state store)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from orrery.operators.score import score


def score_stream(spark: SparkSession, source: str, schema: StructType | str, model: PipelineModel,
                 feature_names: Sequence[str], class_names: Sequence[str], sink: str,
                 checkpoint: str, keep: Sequence[str] = ("obj_id",),
                 model_version: str = "v1.0", available_now: bool = True):
    """Score files arriving in ``source`` into parquet at ``sink``. With
    ``available_now`` the query drains what is there and returns after it stops;
    otherwise the running ``StreamingQuery`` is returned."""
    stream = spark.readStream.schema(schema).parquet(source)
    scored: DataFrame = score(stream, model, feature_names, class_names, keep=keep,
                              model_version=model_version)
    w = scored.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
    q = (w.trigger(availableNow=True) if available_now else w).start()
    if available_now:
        q.awaitTermination()
    return q
