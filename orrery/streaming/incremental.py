"""Structured-Streaming form of "process only what is not yet processed".

New files in the source folder are the arriving rows. A run with
``trigger(availableNow=True)`` handles everything that arrived since the last
run and stops; the checkpoint records which files were seen, so an immediate
second run handles 0 rows.

Every arriving row is kept: those without a target stay unprocessed, those
already processed stay as they are. The sink is a log of ``epoch=<id>``
folders, each written with overwrite, so a retried epoch replaces its own
output; ``read_sink`` gives the last row of each key, which makes the log an
upsert. The medians that fill missing bands are taken once, from what the
source holds when the first run starts, and kept beside the checkpoint: how
files fall into micro-batches doesn't change a result.

``compact`` folds the log into a base, ``_base/<epoch>/bucket=<n>``: the last
row of each key, bucketed by the key's hash. Reads take the newest base and the
epochs after it; only those are searched for the last row of a key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orrery.functions.columns import DEFAULT_BANDS
from orrery.operators.incremental import band_medians, process_incremental


def _medians(spark: SparkSession, path: str, rows: DataFrame, bands: Sequence[str], flag: str) -> dict:
    """The medians kept at ``path``; taken from ``rows`` if there are none yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        got = band_medians(rows.where(~F.col(flag)), bands)
        spark.createDataFrame(list(got.items()), "band string, median double").write.mode("overwrite").parquet(path)
    return {r.band: r.median for r in spark.read.schema("band string, median double").parquet(path).collect()}


def run_incremental(spark: SparkSession, source: str, schema: StructType | str, sink: str,
                    checkpoint: str, bands: Sequence[str] = DEFAULT_BANDS, target: str = "class",
                    flag: str = "is_processed", now=None, key: str = "obj_id",
                    medians: Mapping[str, float] | None = None, max_files: int | None = None,
                    compact_after: int | None = None) -> int:
    """Handle all newly arrived rows; returns how many were read. Of rows with
    one key in one micro-batch the one with the largest row hash counts. The
    sink is compacted at the end of a run that leaves at least
    ``compact_after`` epochs outside its base."""
    totals = {"rows": 0}
    flagged = lambda df: df if flag in df.columns else df.withColumn(flag, F.lit(False))
    if medians is None:
        rows = flagged(spark.read.schema(schema).parquet(source))
        medians = _medians(spark, f"{checkpoint.rstrip('/')}-medians", rows, bands, flag)

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        rows = flagged(batch).persist()
        try:
            totals["rows"] += rows.count()
            new, _ = process_incremental(rows, bands, target, flag, now=now, medians=medians)
            new.write.mode("overwrite").parquet(f"{sink.rstrip('/')}/epoch={epoch_id}")
        finally:
            rows.unpersist()

    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    q = (reader.parquet(source)
              .writeStream.foreachBatch(upsert)
              .option("checkpointLocation", checkpoint)
              .trigger(availableNow=True).start())
    q.awaitTermination()
    if compact_after and len(_epochs(spark, sink)) >= compact_after:
        compact(spark, sink, key)
    return totals["rows"]


def _names(spark: SparkSession, folder: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []


def _base(spark: SparkSession, sink: str) -> int | None:
    """The last epoch of the newest finished base; None without one."""
    folder = f"{sink.rstrip('/')}/_base"
    done = [int(n) for n in _names(spark, folder) if "_SUCCESS" in _names(spark, f"{folder}/{n}")]
    return max(done, default=None)


def _epochs(spark: SparkSession, sink: str) -> list[int]:
    """Finished epochs after the base, ascending."""
    base, sink = _base(spark, sink), sink.rstrip("/")
    found = sorted(int(n[6:]) for n in _names(spark, sink) if n.startswith("epoch="))
    return [e for e in found if (base is None or e > base) and "_SUCCESS" in _names(spark, f"{sink}/epoch={e}")]


def compact(spark: SparkSession, sink: str, key: str = "obj_id", buckets: int = 16) -> int | None:
    """Write a new base of everything up to the last finished epoch; returns
    that epoch, None if there is nothing new. For the sink's one writer, between
    runs. Older bases and epochs stay for readers that have begun: ``vacuum``."""
    new = _epochs(spark, sink)
    if not new:
        return None
    rows = read_sink(spark, sink, key)
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    name = "bucket"
    while name in rows.columns:
        name += "_"
    # rows without a key are dealt by their content, so that no bucket gets them all
    dealt = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*rows.columns), F.lit(buckets)).cast("int")).otherwise(bucket)
    (rows.withColumn(name, dealt).repartition(buckets, name)
     .write.mode("overwrite").partitionBy(name).parquet(f"{sink.rstrip('/')}/_base/{new[-1]}"))
    return new[-1]


def vacuum(spark: SparkSession, sink: str) -> int:
    """Delete the epochs and bases that the newest base has taken in; how many
    folders went. For when no reader that began before ``compact`` is left."""
    base, sink = _base(spark, sink), sink.rstrip("/")
    if base is None:
        return 0
    old = [f"{sink}/{n}" for n in _names(spark, sink) if n.startswith("epoch=") and int(n[6:]) <= base]
    old += [f"{sink}/_base/{n}" for n in _names(spark, f"{sink}/_base") if int(n) != base]
    for folder in old:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return len(old)


def read_sink(spark: SparkSession, sink: str, key: str = "obj_id") -> DataFrame:
    """The last row of each key. A null key is not a key: all its rows stay.
    With a base and no later epoch its files are read as they are; else the
    last row of each key is looked for in the later epochs alone, and replaces
    the base's."""
    base, epochs, sink = _base(spark, sink), _epochs(spark, sink), sink.rstrip("/")
    kept = None
    if base is not None:
        path = f"{sink}/_base/{base}"
        kept = spark.read.parquet(path)
        kept = kept.select(*kept.columns[:-1])  # without the bucket
    if not epochs:
        return spark.read.parquet(sink) if kept is None else kept
    log = spark.read.option("basePath", sink).parquet(*[f"{sink}/epoch={e}" for e in epochs])
    columns = [c for c in log.columns if c != "epoch"]
    last = Window.partitionBy(key).orderBy(F.desc("epoch"), F.desc(F.xxhash64(*columns)))
    new = (log.where(F.col(key).isNotNull()).withColumn("_rn", F.row_number().over(last)).where("_rn = 1")
           .select(*columns).unionByName(log.where(F.col(key).isNull()).select(*columns)))
    if kept is None:
        return new
    return kept.join(log.where(F.col(key).isNotNull()).select(key).distinct(), key, "left_anti").select(*columns).unionByName(new)
