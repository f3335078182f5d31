"""Periodic runs against a search over all periods."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from orrery.llm import periodic
from orrery.llm.queries import op12_periodic

SF = "/root/testdata/sf0.001"


def plain(w, least=6, exponent=4):
    found = {}
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, exponent * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e, q) for (s, e), q in found.items())


def random_words(r):
    w = []
    while len(w) < r.choice([0, 10, 40, 150]):
        unit = [r.randrange(2) for _ in range(r.randrange(1, 9))]
        if r.random() < .3:
            unit = unit * r.randrange(1, 5) + [r.randrange(3)]
        times = r.randrange(1, 7)
        w += unit * times + unit[:r.randrange(len(unit) + 1)]
        w += [r.randrange(3) for _ in range(r.randrange(4))]
    return w


@pytest.mark.parametrize("piece", [3, 16, 50, 1 << 17])
def test_runs_of_random_texts(monkeypatch, piece):
    monkeypatch.setattr(periodic, "PIECE", piece)
    r = random.Random(piece)
    for _ in range(200):
        texts = [random_words(r) for _ in range(r.randrange(1, 5))]
        got = periodic.find([np.array(t, np.int64) for t in texts])
        assert [[tuple(x) for x in g.tolist()] for g in got] == [sorted(plain(t), key=lambda x: (x[0], x[2])) for t in texts]


@pytest.mark.parametrize("least, exponent", [(1, 3), (9, 5)])
def test_other_limits(least, exponent):
    r = random.Random(least)
    for _ in range(200):
        t = random_words(r)
        got = periodic.find([np.array(t, np.int64)], least, exponent)[0]
        assert sorted(map(tuple, got.tolist())) == plain(t, least, exponent)
    with pytest.raises(ValueError):
        periodic.Catchers(6, 2)


def test_equal_sums_of_different_words_are_told_apart(monkeypatch):
    # modulo 3 nearly all windows of two kinds of words look alike
    monkeypatch.setattr(periodic, "PRIME", np.uint64(3))
    r = random.Random(3)
    for _ in range(100):
        t = random_words(r)
        got = {tuple(x) for x in periodic.find([np.array(t, np.int64)])[0].tolist()}
        assert got <= set(plain(t))


def test_long_periodic_text_is_quick():
    t = np.tile(np.r_[np.zeros(40, np.int64), [1]], 5000)
    assert len(periodic.find([t])[0]) == 5001


ROWS = [(1, None, "x"), (2, "", "x"), (3, " \t\n ", "x"), (4, "a " * 5, "x"), (5, "a\n" * 6, "x"), (6, "a b " * 4 + "a", "x"),
        (6, "a b " * 4 + "a", "x"), (None, "x y x y x y x y", None), (7, "A a " * 3 + "ü " * 7 + "漢 " * 9, "x"),
        (8, "Lorem ipsum dolor " * 40 + "tail " + "p q r s " * 5, "x"), (9, "one " * 200_000, "x"),
        (10, "  " * 8, "x")]


def expected(doc_id, text, planted):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if planted and w and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    found = sorted(plain(w), key=lambda x: (x[0], x[2])) if len(w) < 100_000 else [(0, len(w), 1)]
    lost = {i for s, e, q in found for i in range(s + q, e)}
    best = min(found, key=lambda x: (-Fraction(x[1] - x[0], x[2]), x[0], x[2]), default=None)
    one = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *one,
            hashlib.sha256("".join(f"{s},{e - s},{q}\n" for s, e, q in found).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in lost).encode()).hexdigest())


def key(row):
    return tuple((v is None, v) for v in row)


def test_digests(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, runs string").repartition(3)
    got = periodic.digests(periodic.runs(docs)).drop("n_words")
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                           "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted((expected(i, t, False) for i, t, _ in ROWS), key=key)
    assert periodic.digests(periodic.runs(docs.limit(0))).collect() == []


def test_query_on_all_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = op12_periodic(spark, SF).drop("n_words").collect()
    assert sorted(map(tuple, got), key=key) == sorted((expected(r.doc_id, r.text, True) for r in docs), key=key)
    assert any(r.n_runs for r in got)
