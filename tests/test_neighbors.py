import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from orrery import session
from orrery.operators import neighbors
from orrery.operators.neighbors import knn_join, lof_filter, lof_scores
from orrery.operators.smote import smote


def _brute_lof(X, ids, k):
    D = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(D, np.inf)
    nn = np.array([np.lexsort((ids, D[i]))[:k] for i in range(len(X))])
    kd = D[np.arange(len(X))[:, None], nn][:, -1]
    reach = np.maximum(kd[nn], D[np.arange(len(X))[:, None], nn])
    lrd = 1.0 / (reach.mean(1) + 1e-10)
    return -(lrd[nn].mean(1) / lrd), nn


def _clusters(spark):
    rng = np.random.RandomState(3)
    X = np.vstack([rng.normal(0, 0.1, (60, 3)), rng.normal(5, 0.1, (60, 3)), [[20.0, 20.0, 20.0]]])
    ids = np.arange(len(X)) * 10 + 1
    pdf = pd.DataFrame({"id": ids, "vec": list(X), "label": [0] * 60 + [1] * 60 + [1]})
    return spark.createDataFrame(pdf, "id long, vec array<double>, label int"), X, ids


def test_knn_matches_brute_force_with_many_blocks(spark):
    df, X, ids = _clusters(spark)
    got = knn_join(df, 7, "id", "vec", n_pivots=9, block_size=8).toPandas()
    _, nn = _brute_lof(X, ids, 7)
    for qi, q in enumerate(ids):
        g = got[got.id == q].sort_values("rank")
        assert list(g.neighbor_id) == list(ids[nn[qi]])


def test_knn_of_copies_ties_and_batches(spark):
    """Forty equal vectors, ties on a grid and string ids; several regions, small cells and small batches."""
    r = np.random.RandomState(0)
    X = np.vstack([r.normal(0, .1, (80, 3)), np.tile([[1., 1, 1]], (40, 1)), r.randint(0, 4, (80, 3)), [[20., 20, 20]]])
    ids = [f"k{i:04d}" for i in r.permutation(len(X))]
    rows = [(i, v.tolist()) for i, v in zip(ids, X)] + [("none", None)]
    df = spark.createDataFrame(rows, "id string, vec array<double>").repartition(5)
    D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    want = {a: [b for _, b in sorted((D[i, j], b) for j, b in enumerate(ids) if b != a)[:7]] for i, a in enumerate(ids)}
    for args in ({}, {"n_pivots": 5, "block_size": 8, "batch_mb": 0.0005}):
        got = knn_join(df, 7, "id", "vec", **args).orderBy("id", "rank").toPandas()
        assert {a: list(x.neighbor_id) for a, x in got.groupby("id")} == want
    assert knn_join(df.limit(0), 7).columns == ["id", "neighbor_id", "rank", "distance"]
    two = knn_join(df.where("id < 'k0002'"), 7).collect()  # fewer points than k
    assert len(two) == 2 and {r["id"] for r in two} == {"k0000", "k0001"}


def test_search_passes_pairs_through_a_product(monkeypatch):
    """Far from the origin, beside an outlier, with vectors that are not finite and of every scale: the
    pairs of a plain search, and few distances worked out."""
    r = np.random.RandomState(2)
    base = r.normal(size=(600, 24))
    for X in (base, 1e4 + base, 1e12 + base, 1e-60 * base, 1e-160 * base, 1e60 * base, np.vstack([base, np.full((1, 24), 1e15)]),
              np.round(base[:, :2], 1), np.vstack([base, np.full((1, 24), np.nan)])):
        cells = [X[i:i + 60] for i in range(0, len(X), 60)]
        nodes = neighbors._Nodes(pd.DataFrame([neighbors._bounds(c, c.mean(0)) for c in cells]))
        ones = [np.ones(len(c), int) for c in cells]
        D, worked = neighbors._dist_to(X, X), []
        plain = neighbors._dist_to
        monkeypatch.setattr(neighbors, "_dist_to", lambda a, b: (worked.append(len(a) * len(b)), plain(a, b))[1])
        theta = neighbors._search(cells[1], nodes.one(1), ones, np.full(60, np.inf), cells, nodes, 6, 2)[3]
        worked.clear()
        q, e, d, _ = neighbors._search(cells[1], nodes.one(1), ones, theta, cells, nodes, 6)
        monkeypatch.setattr(neighbors, "_dist_to", plain)
        mine = D[60:120]
        kth = np.sort(mine, axis=1)[:, 5:6]
        want = mine <= kth * neighbors.SLACK
        got = np.zeros(mine.shape, bool)
        got[q, e] = True
        assert (got == want).all() and (mine[q, e] == d).all()
        if X is base:
            assert sum(worked) < 2 * 60 * len(cells)  # of the nodes' centres


def test_vectors_of_float_values_take_half_the_bytes():
    X = np.array([[0.5, 1.0], [0.1, 2.0]])
    for v, n in ((X[:1], 8), (X, 32), (np.array([[np.nan, 1.0]]), 16), (np.array([[1e300, 1.0]]), 16)):
        cell = pd.DataFrame([{"vecs": neighbors._packed(v), "n": len(v), "centre": [0.0, 0.0]}]).iloc[0]
        assert len(cell.vecs) == n and np.array_equal(neighbors._vectors(cell), v, equal_nan=True)


def test_lof_matches_numpy_and_far_point_is_removed(spark):
    df, X, ids = _clusters(spark)
    got = lof_scores(df, 20, "id", "vec").toPandas().set_index("id").loc[ids]
    exp, _ = _brute_lof(X, ids, 20)
    np.testing.assert_allclose(got["lof_score"].values, exp, rtol=1e-9)
    kept = lof_filter(df, 20, "id", "vec", contamination=None, threshold=-1.5).toPandas()
    assert 1201 not in set(kept["id"]) and len(kept) == 120


def test_lof_leaves_no_passing_tables(spark):
    """Of the neighbours' tables none stays beside the scores, of a search only those that its result reads."""
    def written(fn):
        before = set(session._STAGES)
        fn()
        return sorted(p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in set(session._STAGES) - before)

    df, _, _ = _clusters(spark)
    assert written(lambda: lof_filter(df, 5, "id", "vec").collect()) == ["stage"]
    assert written(lambda: lof_scores(df, 5, "id", "vec").collect()) == ["knn", "lrd"]
    assert written(lambda: knn_join(df, 5, "id", "vec").collect()) == ["knn-entries", "knn-lists", "knn-points"]


def test_smote_balances_and_stays_on_segments(spark):
    rows = [(i, [float(i), float(i % 5)], 0) for i in range(7)] + \
           [(100 + i, [10.0 + i, 1.0], 1) for i in range(3)] + [(200 + i, [-5.0, float(i)], 2) for i in range(2)]
    df = spark.createDataFrame(rows, "id long, vec array<double>, label int")
    out = smote(df, "label", "id", "vec", k=5, seed=42).toPandas()
    assert out.groupby("label").size().to_dict() == {0: 7, 1: 7, 2: 7}
    src = {r[0]: np.array(r[1]) for r in rows}
    lab = {r[0]: r[2] for r in rows}
    for _, r in out[out.is_synthetic].iterrows():
        a, b, x = src[r.source_id], src[r.neighbor_id], np.array(r.vec)
        assert lab[r.source_id] == lab[r.neighbor_id] == r.label
        t = np.dot(x - a, b - a) / np.dot(b - a, b - a)
        assert -1e-12 <= t < 1 and np.allclose(a + t * (b - a), x)


def test_catalog_lof_matches_brute_force(spark):
    """The registered catalog LOF (raw numeric columns, k=20) against NumPy on
    the sf0.001 catalog (keys that repeat at that scale are left out)."""
    from pyspark.sql import functions as F
    from pyspark.sql import Window
    from orrery.plans.catalog import catalog_points
    from tests.conftest import SF_SMALL
    pts = catalog_points(spark, SF_SMALL)
    pts = (pts.withColumn("_n", F.count("*").over(Window.partitionBy("obj_id")))
              .where("_n = 1").drop("_n").limit(1500))
    pdf = pts.toPandas()
    got = lof_scores(spark.createDataFrame(pdf), 20, "obj_id", "vec").toPandas().set_index("obj_id")
    X = np.stack(pdf.vec.values)
    ids = pdf.obj_id.values
    exp, _ = _brute_lof(X, ids, 20)
    np.testing.assert_allclose(got.loc[ids, "lof_score"].values, exp, rtol=1e-9)


def test_smote_keeps_classes_of_any_type_apart(spark):
    from orrery.operators.smote import smote
    rows = [(i, "a", [float(i % 5), 0.0]) for i in range(12)] + [(20 + i, "b", [100.0 + i, 0.0]) for i in range(3)]
    for cast in ("string", "double"):
        lab = F.col("label") if cast == "string" else F.when(F.col("label") == "a", 0.2).otherwise(0.7)
        df = spark.createDataFrame(rows, "id long, label string, vec array<double>").withColumn("label", lab)
        out = smote(df, "label", "id", "vec", k=2).where("is_synthetic").collect()
        assert len(out) == 9 and all(r.vec[0] >= 100 for r in out)
