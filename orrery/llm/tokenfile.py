"""Token ids as Arrow files of equal-length sequences.

Each shard is one Arrow IPC file. A row of its record batches is one sequence:
``ids`` (fixed-size list of the smallest unsigned type that holds the
vocabulary) and ``mask`` (fixed-size list of bits, false on the padding at the
shard's end). All batches but the last have the same number of rows, so
sequence i is row i % rows of batch i // rows and is read from the mapped file
without a copy.

Documents lie one after the other in ascending id order, over shards too; an
index row per document says where it begins.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from orrery.llm import bpe
from orrery.llm.common import batches, kept, make_dir, mapped, open_fs, open_mapped

ROWS = 256  # sequences in a record batch
PIECES = 1_000_000  # pieces whose ids a Python worker keeps, at about 200 bytes


class LibraryEncoder:
    """Whole-text ids by the ``tokenizers`` library.

    Where the file has the plain byte-level pre-tokenizer and no normalizer,
    pieces are independent of each other: the library then encodes each
    distinct piece of a batch once and a bounded table keeps its ids. For any
    other file it encodes the whole text."""

    def __init__(self, source: bytes):
        spec = json.loads(source)
        self.library = Tokenizer.from_buffer(source)
        self.library.no_truncation()
        self.library.no_padding()
        pre = spec["pre_tokenizer"] or {}
        self.by_piece = (spec["normalizer"] is None and pre.get("type") == "ByteLevel" and pre.get("use_regex")
                         and not pre.get("add_prefix_space") and spec["post_processor"] is None
                         and not any(a[k] for a in spec["added_tokens"]
                                     for k in ("single_word", "lstrip", "rstrip", "normalized")))
        self.size = self.library.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype(np.uint16 if self.size <= 1 << 16 else np.uint32)
        self.added = [a["content"] for a in spec["added_tokens"]]
        self.pattern = bpe._pattern(bpe.BYTE_LEVEL_PATTERN)
        self.narrow = bpe.narrow_pattern(bpe.BYTE_LEVEL_PATTERN)
        self.pieces: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        kind = "H" if self.dtype.itemsize == 2 else "I"
        return [array(kind, e.ids).tobytes()
                for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as the bytes of an array of ``dtype``."""
        # a text with the string of an added token goes to the library whole
        plain = [self.by_piece and not any(a in t for a in self.added) for t in texts]
        whole = iter(self._ids([t for t, p in zip(texts, plain) if not p]))
        if len(self.pieces) > PIECES:
            self.pieces.clear()
        split, get = [], self.pieces.get
        missing: dict[str, None] = {}
        for t, p in zip(texts, plain):
            parts = (self.pattern if bpe.BEYOND(t) else self.narrow).findall(t) if p else []
            got = list(map(get, parts))
            if None in got:
                missing.update((x, None) for x, g in zip(parts, got) if g is None)
                got = None
            split.append((parts, got))
        new = list(missing)
        self.pieces.update(zip(new, self._ids(new)))
        return [b"".join(got if got is not None else map(get, parts)) if p else next(whole)
                for p, (parts, got) in zip(plain, split)]


_ENCODERS: dict[str, LibraryEncoder] = kept(__name__, {})


def encoder_of(source: bytes) -> LibraryEncoder:
    key = hashlib.sha256(source).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS[key] = LibraryEncoder(source)
    return _ENCODERS[key]


class ShardWriter:
    """Appends ids to one file; holds less than one record batch."""

    def __init__(self, uri: str, dtype: np.dtype, length: int):
        fs, path = open_fs(uri)
        kind = pa.from_numpy_dtype(dtype)
        self.length, self.dtype, self.total = length, dtype, 0
        self.schema = pa.schema([("ids", pa.list_(pa.field("item", kind, False), length)),
                                 ("mask", pa.list_(pa.field("item", pa.bool_(), False), length))])
        self.out = fs.open_output_stream(path, compression=None)
        self.writer = pa.ipc.new_file(self.out, self.schema)
        self.kept, self.n = [], 0

    def add(self, ids: np.ndarray) -> None:
        self.kept.append(ids)
        self.n += len(ids)
        self.total += len(ids)
        full = self.length * ROWS
        if self.n >= full:
            flat = np.concatenate(self.kept)
            cut = len(flat) // full * full
            for k in range(0, cut, full):
                self._batch(flat[k:k + full], full)
            self.kept, self.n = [flat[cut:].copy()], len(flat) - cut

    def _batch(self, ids: np.ndarray, valid: int) -> None:
        mask = np.arange(len(ids)) < valid
        self.writer.write_batch(pa.record_batch(
            [pa.FixedSizeListArray.from_arrays(pa.array(ids), type=self.schema.field(0).type),
             pa.FixedSizeListArray.from_arrays(pa.array(mask), type=self.schema.field(1).type)],
            schema=self.schema))

    def close(self) -> None:
        if self.n:
            flat = np.concatenate(self.kept)
            padded = np.zeros(-(-len(flat) // self.length) * self.length, self.dtype)
            padded[:len(flat)] = flat
            self._batch(padded, len(flat))
        self.writer.close()
        self.out.close()


class ShardReader:
    """Random access to one file."""

    def __init__(self, uri: str):
        self.file = pa.ipc.open_file(open_mapped(uri))
        kind = self.file.schema.field("ids").type
        self.length = kind.list_size
        self.full = self.length * (self.file.get_batch(0).num_rows if self.file.num_record_batches else 1)

    def sequence(self, i: int) -> tuple[pa.Array, pa.Array]:
        """(ids, mask) of sequence i, without a copy where the file is mapped."""
        rows = self.full // self.length
        b = self.file.get_batch(i // rows)
        return b.column(0)[i % rows].values, b.column(1)[i % rows].values

    def spans(self, start: int, n: int) -> Iterator[np.ndarray]:
        """ids[start:start + n] of the shard, in pieces."""
        while n > 0:
            k, at = divmod(start, self.full)
            flat = self.file.get_batch(k).column(0).flatten().to_numpy()[at:at + n]
            if not len(flat):
                raise ValueError("the range is beyond the shard's end")
            yield flat
            start, n = start + len(flat), n - len(flat)


def write(docs: DataFrame, path: str, folder: str, end_id: int, length: int = 2048, shards: int | None = None,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode each whole text with the tokenizer file at ``path``, append
    ``end_id`` and write the ids of all documents in ascending id order under
    ``folder``, in shards of sequences of ``length`` ids. Returns the index: a
    row per document with its id, ``start`` (ids of all documents before it),
    ``n_tokens`` (with the end id), ``shard`` (file) and ``at`` (place there).

    Null and empty texts have the end id alone. A null id comes first; rows of
    equal id follow their texts' hash, and equal rows any order. An empty table
    gives no files and an empty index. Other columns are not read.

    A task writes its shard under a name of its own; the index, which Spark
    commits once for each task, names the files that count."""
    spark = docs.sparkSession
    source = bpe.read_model(path)
    shared = spark.sparkContext.broadcast(source)
    folder = folder.rstrip("/")
    index_path = f"{folder}/index"
    make_dir(folder)
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    src = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
           .withColumn("tie", F.xxhash64("text")))
    src = src.repartitionByRange(n, "id", "tie").sortWithinPartitions("id", "tie").select("id", "text")
    src = src.withColumn("part", F.spark_partition_id())
    schema = T.StructType([src.schema["id"]]).add("shard", "string").add("at", "long").add(
        "n_tokens", "long").add("part", "integer")

    def run(it):
        enc = encoder_of(shared.value)
        out = shard = None
        try:
            for b in batches(it, 4 << 20, "text"):
                if out is None:
                    shard = f"{folder}/shard-{b.column(2)[0].as_py():06d}-{uuid.uuid4().hex}.arrow"
                    out = ShardWriter(shard, enc.dtype, length)
                texts = [t or "" for t in b.column(1).to_pylist()]
                at, sizes = [], []
                for ids in enc.encode(texts):
                    ids = np.append(np.frombuffer(ids, enc.dtype), enc.dtype.type(end_id))
                    at.append(out.total)
                    sizes.append(len(ids))
                    out.add(ids)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([shard] * len(at), pa.string()), pa.array(at, pa.int64()),
                     pa.array(sizes, pa.int64()), b.column(2)], schema=pa.schema(
                        [b.schema.field(0), ("shard", pa.string()), ("at", pa.int64()), ("n_tokens", pa.int64()),
                         ("part", pa.int32())]))
        finally:
            if out is not None:
                out.close()

    src.transform(mapped, run, schema).write.parquet(index_path)
    index = spark.read.schema(schema).parquet(index_path)
    # ids before each shard: as many numbers as shards
    totals = sorted((r.part, r.n) for r in index.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    before = np.r_[0, np.cumsum([t for _, t in totals])].tolist()
    offsets = spark.createDataFrame([(p, b) for (p, _), b in zip(totals, before)], "part int, before long")
    return (index.join(F.broadcast(offsets), "part")
            .select(F.col("id").alias(id_col), (F.col("before") + F.col("at")).alias("start"), "n_tokens", "shard", "at"))


def read_crc(index: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``index`` with ids_crc32, the crc32 of each document's ids, read back
    from its shard, as little-endian unsigned 32-bit integers."""
    # by shard, over a fixed number of tasks: an index row is small, what it names is not
    n = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    src = (index.select(id_col, "start", "n_tokens", "shard", "at").repartition(n, "shard")
           .sortWithinPartitions("shard", "at"))
    schema = T.StructType([*src.schema.fields, T.StructField("ids_crc32", T.LongType())])

    def run(it):
        name = reader = None
        for b in it:
            out = []
            for shard, at, n in zip(*(b.column(k).to_pylist() for k in (3, 4, 2))):
                if shard != name:
                    name, reader = shard, ShardReader(shard)
                crc = 0
                for ids in reader.spans(at, n):
                    crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
                out.append(crc)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.int64())],
                                             names=[*b.schema.names, "ids_crc32"])

    return src.transform(mapped, run, schema)
