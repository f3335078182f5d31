"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable, Iterator
from contextlib import suppress

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.session import drop_stage, release, ship_package, stage_path  # noqa: F401 (others take release from here)



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a shared folder (file:, hdfs:, s3:, gs: or plain)."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") \
        else (pafs.LocalFileSystem(), uri)


def open_mapped(uri: str) -> pa.NativeFile:
    """A file for random access: memory-mapped where the store allows it."""
    fs, path = open_fs(uri)
    return pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path)


def make_dir(uri: str) -> None:
    fs, path = open_fs(uri)
    fs.create_dir(path, recursive=True)


ROWS_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROWS = 2000  # texts in an Arrow batch, where the session leaves Spark's default of 10,000


_KEPT: list[tuple[str, dict]] = []


def kept(owner: str, table: dict) -> dict:
    """A table that a module keeps in Python workers from task to task. Tasks
    of other modules empty it: a worker holds what its present work needs."""
    _KEPT.append((owner, table))
    return table


def let_go(owner: str) -> None:
    """Empty what modules other than ``owner`` keep in this worker."""
    others = [t for name, t in _KEPT if name != owner and t]
    for t in others:
        t.clear()
    if others:
        trim()


def mapped(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow`` with this package on the executors, batches of a size
    for texts, and workers that give the memory of a task back when it ends,
    and that of other operators when it begins."""
    spark = df.sparkSession
    ship_package(spark)
    if spark.conf.get(ROWS_SETTING, "10000") == "10000":
        spark.conf.set(ROWS_SETTING, str(ROWS))

    owner = run.__module__

    def lean(it):
        let_go(owner)
        try:
            yield from run(it)
        finally:
            trim()

    return df.mapInArrow(lean, schema)


def trim() -> None:
    """Return freed memory to the system: Python workers outlive their tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # glibc has it; others need none
        ctypes.CDLL(None).malloc_trim(0)


def batches(it: Iterable[pa.RecordBatch], limit: int, column: str) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` holds about ``limit`` bytes in
    each; a longer single row comes alone and whole."""
    for b in it:
        c = b.column(b.schema.get_field_index(column))
        if b.num_rows == 0:
            continue
        sizes = np.nan_to_num(np.asarray(
            pc.binary_length(c).cast(pa.float64()).to_numpy(zero_copy_only=False)))
        part = (np.cumsum(sizes) // limit).astype(np.int64)
        cut = np.flatnonzero(np.diff(part)) + 1
        for lo, hi in zip(np.r_[0, cut], np.r_[cut, b.num_rows]):
            yield b.slice(int(lo), int(hi - lo))


def text_bytes(col: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null: empty."""
    return [b"" if v is None else v for v in col.cast(pa.binary()).to_pylist()]


def free_name(taken: list[str], name: str) -> str:
    """``name``, with as many underscores as make it differ from all taken."""
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


def aside(docs: DataFrame, taken) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its columns of the names ``taken`` under free names, and
    the new names by the old ones."""
    low = {t.lower() for t in taken}
    names, used = {}, [*docs.columns, *taken]
    for c in docs.columns:
        if c.lower() in low:
            names[c] = free_name(used, c)
            used.append(names[c])
    return docs.withColumnsRenamed(names), names


def back(got: DataFrame, docs: DataFrame, names: dict[str, str]) -> DataFrame:
    """The columns of ``docs`` under their own names, after ``aside``."""
    return got.select(*[F.col(f"`{names.get(c, c)}`").alias(c) for c in docs.columns])


def text_of_bytes(col: str):
    """Column expression: the text of UTF-8 bytes, without the characters of
    which bytes are missing."""
    return F.pandas_udf(_utf8, "string")(F.col(col))


def _utf8(col: pd.Series) -> pd.Series:
    return col.map(lambda b: None if b is None else bytes(b).decode("utf-8", "ignore"))


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``: root is the smallest
    node of its connected component. Alternating large-star and small-star
    rounds, each one aggregate and one join over the edges; each round is a
    written table. Rows stay about as many as the edges. An empty table of
    edges gives an empty result. Raises when ``max_rounds`` do not suffice."""
    spark = edges.sparkSession

    def write(df):
        path = stage_path(spark, "components")
        df.write.parquet(path)
        out = spark.read.schema(df.schema).parquet(path)
        stat = out.agg(F.count("*").alias("n"), F.sum(F.hash("a", "b").cast("long")).alias("h")).first()
        return path, out, (stat.n, stat.h)

    def star(e, large):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if large:
            # every larger neighbour is linked to the smallest neighbour (or the node itself)
            low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
            return (both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                    .where("a > b").distinct())
        low = e.groupBy("a").agg(F.min("b").alias("m"))
        link = e.join(low, "a")
        return (link.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                .unionByName(low.select("a", F.col("m").alias("b"))).where("a > b").distinct())

    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    path, now, seen = write(e)
    for _ in range(max_rounds):
        p1, mid, _ = write(star(now, True))
        p2, new, stat = write(star(mid, False))
        drop_stage(spark, path, p1)
        path, now = p2, new
        if stat == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = stat
    raise RuntimeError(f"components: not settled after {max_rounds} rounds")
