"""Binned feature tables: the one form of the training data that tree learners
and tuning read, again and again.

Each feature is cut into at most 256 bins at quantiles of its values (at the
values themselves where there are no more), so that a row is one byte a
feature. Rows are packed into blocks of some ten thousand, one table row each
with binary columns: a pass over the table hands whole blocks to NumPy and has
no cost a row in Spark. The table is written once under the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.session import cut_lineage, set_for, ship_package

BINS = 256
ROWS = 32_768  # rows in a block
MAX_CLASSES = 256
SUMS_MB = 64  # sums that come to the driver at once
AT_ONCE = 4  # blocks of a batch between the JVM and Python: some MB each, held on both sides

_FIELDS = [("codes", np.uint8), ("label", np.uint8), ("id", np.int64), ("fold", np.uint8)]


def quantile_edges(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """For each feature the values that part its bins, ascending: about equal
    numbers of rows lie between two (rank error below a tenth of a bin). A
    feature of fewer values has them all; one without values has none. One
    pass, one sketch a feature."""
    if not 2 <= bins <= BINS:
        raise ValueError(f"2 to {BINS} bins")
    probs = [i / bins for i in range(1, bins)]
    row = df.agg(*[F.percentile_approx(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)), probs, 20 * bins)
                   .alias(f"e{j}") for j, c in enumerate(features)]).first()
    return [np.unique(np.array(row[j] or [], np.float64)) for j in range(len(features))]


def encode(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Bin of each value: the number of edges below it. A missing value (NaN)
    counts as the smallest."""
    return np.where(np.isnan(values), 0, np.searchsorted(edges, values, "left")).astype(np.uint8)


@dataclass
class Block:
    codes: np.ndarray  # features x rows
    label: np.ndarray
    id: np.ndarray  # 64-bit hashes of the rows' keys
    fold: np.ndarray

    @property
    def n(self) -> int:
        return len(self.label)


@dataclass
class Binned:
    """A written binned table: ``blocks`` (n, codes, label, id, fold)."""

    blocks: DataFrame
    features: list[str]
    edges: list[np.ndarray]
    classes: int
    rows: int

    @property
    def bins(self) -> int:
        return max([2, *(len(e) + 1 for e in self.edges)])

    def cached(self) -> Binned:
        """With blocks kept by the executors; what is lost is read again."""
        return Binned(self.blocks.persist(StorageLevel.MEMORY_AND_DISK), self.features, self.edges, self.classes, self.rows)


def binned(df: DataFrame, features: Sequence[str], label: str = "label", key_cols: Sequence[str] = ("obj_id",),
           fold: Column | None = None, edges: Sequence[Sequence[float]] | None = None, bins: int = BINS) -> Binned:
    """Write the binned table of ``df``: labels are whole numbers 0 to k - 1
    (rows of a NULL label are left out), ``fold`` a number 0 to 255 a row.
    ``edges`` gives the bins' limits in place of quantiles. Missing feature
    values count as the smallest. Rows keep the partitions that they have."""
    df = df.where(F.col(f"`{label}`").isNotNull())
    features = list(features)
    edges = quantile_edges(df, features, bins) if edges is None else [np.asarray(e, np.float64) for e in edges]
    if any(len(e) >= BINS for e in edges):
        raise ValueError(f"more than {BINS} bins")
    src = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{j}") for j, c in enumerate(features)],
                    F.col(f"`{label}`").cast("int").alias("label"),
                    F.xxhash64(*[F.col(f"`{c}`") for c in key_cols]).alias("id"),
                    (F.lit(0) if fold is None else fold).cast("int").alias("fold"))
    m = len(features)

    def pack(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(batches).combine_chunks()
        codes = np.stack([encode(t.column(j).to_numpy(), edges[j]) for j in range(m)]) if m else np.zeros((0, len(t)))
        label = t.column(m).to_numpy()
        if len(label) and not 0 <= label.min() <= label.max() < MAX_CLASSES:
            raise ValueError(f"labels are whole numbers from 0 to {MAX_CLASSES - 1}")
        cells = [codes, label, t.column(m + 1).to_numpy(), t.column(m + 2).to_numpy()]
        return pa.RecordBatch.from_arrays(
            [pa.array([len(t)], pa.int32()), pa.array([int(label.max(initial=0))], pa.int32()),
             *(pa.array([np.ascontiguousarray(c, kind).tobytes()], pa.binary()) for c, (_, kind) in zip(cells, _FIELDS))],
            names=["n", "top", *(name for name, _ in _FIELDS)])

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in it:
            held.append(b)
            n += b.num_rows
            if n >= ROWS:
                yield pack(held)
                held, n = [], 0
        if n:
            yield pack(held)

    ship_package(df.sparkSession)
    blocks = cut_lineage(src.mapInArrow(
        run, "n int, top int, codes binary, label binary, id binary, fold binary"), "binned")
    rows, top = blocks.agg(F.coalesce(F.sum("n"), F.lit(0)), F.max("top")).first()
    return Binned(blocks.drop("top"), features, list(edges), 1 + (top or 0), int(rows))


def read_blocks(it: Iterable[pa.RecordBatch], extra: Sequence[str] = ()) -> Iterator[tuple]:
    """Blocks of Arrow batches, each with the binary columns ``extra``."""
    for b in it:
        for n, *cells in zip(b.column(b.schema.get_field_index("n")).to_pylist(), *(uncopied(b, c) for c, _ in _FIELDS),
                             *(uncopied(b, c) for c in extra)):
            codes, label, id_, fold = (np.frombuffer(c, kind) for c, (_, kind) in zip(cells, _FIELDS))
            yield (Block(codes.reshape(-1, n), label, id_, fold), *cells[len(_FIELDS):])


def uncopied(b: pa.RecordBatch, name: str) -> Iterator[pa.Buffer | None]:
    """The bytes of each row of a binary column where they are; None where it is null."""
    return (x.as_buffer() if x.is_valid else None for x in b.column(b.schema.get_field_index(name)))


def few_blocks(spark):
    """Scope of plans whose batches hold AT_ONCE blocks, whatever a partition holds."""
    return set_for(spark, spark__sql__execution__arrow__maxRecordsPerBatch=str(AT_ONCE))


def sums(blocks: DataFrame, of_task: Callable[[Iterable], dict[int, np.ndarray]], extra: Sequence[str] = (),
         reader: Callable = read_blocks, size: int | None = None) -> dict[int, np.ndarray]:
    """Arrays summed over all blocks: ``of_task`` makes a dict of slot ->
    float64 array from the blocks of one task. Arrays of a slot are added in
    one task each and come to the driver, which bounds them beforehand. Where
    the arrays of all tasks, of ``size`` bytes each, are within SUMS_MB, the
    driver adds them."""
    ship_package(blocks.sparkSession)

    def first(it):
        for slot, value in of_task(reader(it, extra)).items():
            yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([value.tobytes()], pa.binary())],
                                             names=["slot", "value"])

    def add(it):
        total: dict[int, np.ndarray] = {}
        for b in it:
            for slot, value in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                v = np.frombuffer(value)
                total[slot] = total[slot] + v if slot in total else v
        for slot, v in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([v.tobytes()], pa.binary())],
                                             names=["slot", "value"])

    schema = "slot int, value binary"
    parts = blocks.mapInArrow(first, schema)
    if size is None or size * tasks_of(blocks) > SUMS_MB * 2**20:
        parts = parts.repartition("slot").mapInArrow(add, schema)
    out: dict[int, np.ndarray] = {}
    with few_blocks(blocks.sparkSession):
        got = parts.collect()
    for r in got:
        v = np.frombuffer(r.value)
        out[r.slot] = out[r.slot] + v if r.slot in out else v
    return out


def tasks_of(df: DataFrame) -> int:
    """Number of partitions, asked for once a table."""
    if not hasattr(df, "_orrery_tasks"):
        df._orrery_tasks = df.rdd.getNumPartitions()
    return df._orrery_tasks
