"""Approximate neighbours: the curve, recall, and odd vectors."""

import numpy as np
import pytest

from orrery.llm import ann

SCHEMA = "vec_id long, embedding array<float>, ids int, gid int"


def test_hilbert_visits_neighbouring_cells():
    axes, levels = 3, 3
    n = 1 << levels
    cells = np.stack(np.meshgrid(*[np.arange(n)] * axes), -1).reshape(-1, axes)
    key = ann.hilbert(cells, levels)
    path = cells[np.argsort(key)]
    assert sorted(key.tolist()) == list(range(n**axes))
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def exact(ids, x, k, every):
    out = {}
    for i, q in zip(ids, x):
        if i % every == 0:
            s = x.astype(np.float64) @ q.astype(np.float64)
            rows = sorted((-v, j) for v, j in zip(s, ids) if j != i)[:k]
            out[i] = [(j, -v) for v, j in rows]
    return out


def test_recall_and_order(spark):
    rng = np.random.default_rng(1)
    x = (rng.normal(size=(3000, 16)) * rng.uniform(0.5, 2, size=(3000, 1))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 0, 0) for i, v in enumerate(x)], SCHEMA)
    got = {}
    for r in ann.search(df, k=10, every=20, block=128, curves=12).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = exact(range(3000), x, 10, 20)
    assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())
    hit = sum(len({j for j, _ in got[q]} & {j for j, _ in want[q]}) for q in want)
    assert hit / (10 * len(want)) >= 0.9
    for q, rows in got.items():
        assert rows == sorted(rows, key=lambda r: (-r[1], r[0]))
        for j, s in rows:
            assert s == pytest.approx(float(x[q].astype(np.float64) @ x[j].astype(np.float64)), abs=1e-12)


def test_copies_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0, 0.5], 0, 0) for i in range(100)] + [(200 + i, [1.0, float(i), 0.0], 0, 0) for i in range(5)]
    rows += [(300, None, 0, 0), (320, [0.0, 0.0, 0.0], 0, 0), (340, [1.0, None, 0.0], 0, 0), (360, [nan, 1.0, 1.0], 0, 0),
             (380, [inf, 1.0, 1.0], 0, 0), (400, [1.0], 0, 0), (None, [1.0, 1.0, 1.0], 0, 0), (20, [1.0, 0.0, 0.5], 0, 0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {}
    for r in ann.search(df, k=20, every=20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 6)))
    valid = {i: v for i, v, _, _ in rows if i is not None and i not in (300, 320, 340, 360, 380, 400)}
    want = exact(list(valid), np.array(list(valid.values()), np.float32), 20, 20)
    assert got == {q: [(j, round(float(s), 6)) for j, s in v] for q, v in want.items()}
    assert ann.search(df.limit(0)).count() == 0
    assert ann.search(df.where("vec_id = 20")).count() == 0


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def one_long(rng, n):
    x = unit(rng.normal(size=(n, 16)))
    x[7] *= 100
    return x


def one_cluster(rng, n):
    x = unit(rng.normal(size=(n, 16)))
    x[: n // 3] = unit(x[0] + 5e-5 * rng.normal(size=(n // 3, 16)))
    return x[rng.permutation(n)]


def even(rng, n):
    return unit(rng.normal(size=(n, 64)))


@pytest.mark.parametrize("made, n", [(one_long, 4000), (one_cluster, 4000), (even, 12000)])
def test_recall_holds_on_skewed_vectors_and_larger_tables(spark, made, n):
    x = made(np.random.default_rng(5), n).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 0, 0) for i, v in enumerate(x)], SCHEMA)
    got = {}
    for r in ann.search(df, k=10, every=20, block=64, curves=12).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = exact(range(n), x, 10, 20)
    assert got.keys() == want.keys()
    assert sum(len(got[q] & {j for j, _ in want[q]}) for q in want) / (10 * len(want)) >= 0.9
