"""Documents to token ids, in five stages. Each stage works on every document
that the one before kept; each result is written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm import bpe, decontaminate, langid, simhash, suffixdedup
from orrery.llm.common import table, text_of_bytes
from orrery.session import cut_lineage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language; learned from the labelled ones."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return langid.keep_known(docs, langid.train(docs.where(~held_out)))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the smallest doc_id."""
    return simhash.drop_near_duplicates(docs, size=3, max_bits=2)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of repeated 200-byte strings; a character that
    loses a byte goes whole. n_chars is that of the text that is left."""
    got = suffixdedup.remove_repeats(docs, length=200)
    cut = F.col("n_removed") > 0
    text = F.when(cut, text_of_bytes("kept")).otherwise(F.col("text"))
    chars = F.when(cut, F.length(text).cast("long")).otherwise(F.col("n_chars"))
    return got.withColumns({"text": text, "n_chars": chars}).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a 10-word window of a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), window=10)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and digests of them and of the text decoded again."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.digests(bpe.encode(docs.select("doc_id", "text"), path), path, ids=True)


STAGES = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("bpe_encoding", bpe_encoding),
]

# languages, hashes of shingles and BPE are beyond SQL; the tests hold run() against a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over all documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return docs
