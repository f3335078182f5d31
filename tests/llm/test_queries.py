"""The registered queries at the smallest size: SQL where there is some, and
the pipeline against a plain version."""

import unicodedata
from collections import Counter

import pytest
from tests.llm.test_dedup import plain_components, plain_fingerprint, plain_inspect, plain_removed
from tokenizers import Tokenizer

import corpus_pipeline
from orrery.llm import langid
from orrery.llm.queries import QUERIES, SQL
from tools.check_oracle import compare, duck

SF = "/root/testdata/sf0.001"


def test_registered_queries():
    assert sorted(QUERIES) == sorted([*(n for n in QUERIES if n.startswith("op")), "pipeline"])
    assert {n[2:].split("_")[0] for n in QUERIES if n != "pipeline"} == {str(k) for k in range(1, 14)}


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql_agrees(spark, name):
    got = compare(spark, duck(SF), name, QUERIES[name], SQL[name], SF)
    assert got[0] if isinstance(got, tuple) else got


def test_pipeline(spark):
    import public_tokenizers
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    stage1 = {r.doc_id for r in corpus_pipeline.language_id(
        spark, spark.read.parquet(f"{SF}/documents.parquet"), SF).collect()}
    # which documents have a language is the model's to say; those without a letter have none
    assert stage1 <= {r.doc_id for r in rows if any(map(str.isalpha, r.text or ""))}
    docs = [r for r in rows if r.doc_id in stage1]
    comp = plain_components([plain_fingerprint(r.text) for r in docs], [r.doc_id for r in docs], 2)
    docs = [r for r, c in zip(docs, comp) if r.doc_id == c]
    kept = [w[3].decode("utf-8", "ignore") for w in plain_removed([r.text for r in docs], 200)]
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter((r.doc_id, tuple(lib.encode(t, add_special_tokens=False).ids))
                   for r, t in zip(docs, kept) if not plain_inspect(t, items, 10)[1])
    got = corpus_pipeline.run(spark, SF)
    assert Counter((r.doc_id, tuple(r.ids)) for r in got.collect()) == want
    assert langid.UNKNOWN == "und" and unicodedata.category("é") == "Ll"
