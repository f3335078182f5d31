import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from orrery.operators.clean import clean, impute_median, missing_counts, nan_to_null
from orrery.operators.quantiles import exact_quantiles
from orrery.operators.profile import correlation_matrix, describe


def test_nan_and_null_are_both_missing(spark):
    df = spark.createDataFrame([(1.0, 1), (float("nan"), None), (None, 3)], "a double, b int")
    m = {r["column_name"]: r["n_missing"] for r in missing_counts(df).collect()}
    assert m == {"a": 2, "b": 1, "__total__": 3}
    assert nan_to_null(df).where(F.col("a").isNull()).count() == 2


def test_impute_median_pandas_semantics(spark):
    pdf = pd.DataFrame({"a": [1.0, None, 4.0, 10.0], "b": [None, None, None, None],
                        "c": [5.0, 5.0, 5.0, 5.0], "k": ["x", "y", "z", None]})
    df = spark.createDataFrame(pdf, "a double, b double, c double, k string")
    out = impute_median(df).orderBy("a").toPandas()
    assert sorted(out["a"]) == [1.0, 4.0, 4.0, 10.0]            # median of 1, 4, 10
    assert out["b"].isna().all()                                 # all-NULL stays NULL
    assert (out["c"] == 5.0).all()                               # no NULLs: untouched
    assert clean(df, target="k").count() == 3                    # NULL target dropped after impute


def test_even_count_median_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,), (None,)], "a double")
    q = exact_quantiles(df, ["a"], [0.5, 0.25, 0.0, 1.0])
    assert q[("a", 0.5)] == 3.0
    assert q[("a", 0.25)] == np.percentile([1, 2, 4, 10], 25)
    assert (q[("a", 0.0)], q[("a", 1.0)]) == (1.0, 10.0)


def test_bracketed_quantiles_match_numpy(spark):
    rng = np.random.RandomState(0)
    vals = np.concatenate([rng.normal(size=30000), np.full(5000, 0.5)])
    df = spark.createDataFrame(pd.DataFrame({"v": vals})).repartition(8)
    probs = [0.01, 0.1, 0.5, 0.77, 0.99]
    q = exact_quantiles(df, ["v"], probs, accuracy=200, max_exact=500)   # forces bracketing rounds
    for p in probs:
        assert math.isclose(q[("v", p)], np.percentile(vals, 100 * p), rel_tol=0, abs_tol=1e-12)


def test_describe_and_constant_correlation(spark):
    df = spark.createDataFrame([(1.0, 7.0, 2.0), (2.0, 7.0, 4.0), (4.0, 7.0, 8.0)], "a double, c double, b double")
    d = {r["column_name"]: r for r in describe(df).collect()}
    assert d["a"]["q50"] == 2.0 and d["a"]["count"] == 3 and d["c"]["std"] == 0.0
    corr = {(r["col_a"], r["col_b"]): r["corr"] for r in correlation_matrix(df).collect()}
    assert corr[("a", "b")] == 1.0 and corr[("a", "c")] is None and corr[("c", "c")] is None


def test_pairwise_complete_correlation(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, 3.0, 4.0, None], "b": [2.0, 1.0, 4.0, 3.0, 9.0]})
    df = spark.createDataFrame(pdf)
    corr = {(r["col_a"], r["col_b"]): r["corr"] for r in correlation_matrix(df, digits=None).collect()}
    assert math.isclose(corr[("a", "b")], pdf.corr().loc["a", "b"], rel_tol=1e-12)


@pytest.mark.parametrize("max_exact", [100, 100_000])
def test_quantiles_of_constant_few_valued_and_continuous_columns(spark, max_exact):
    rng = np.random.default_rng(0)
    n = 5000
    p = pd.DataFrame({"same": np.ones(n), "few": rng.integers(0, 3, n).astype(float), "x": rng.normal(size=n),
                      "mixed": np.where(rng.random(n) < 0.5, 7.0, rng.normal(size=n))})
    probs = [0, 0.1, 0.5, 0.99, 1]
    got = exact_quantiles(spark.createDataFrame(p), list(p.columns), probs, accuracy=200, max_exact=max_exact)
    for c in p.columns:
        for q in probs:
            assert got[c, q] == pytest.approx(p[c].quantile(q), abs=1e-12)


def test_stored_profile_reads_footers_alone(spark):
    from orrery.operators.profile import footer_plan, stored_profile
    from orrery.session import stage_path
    path = stage_path(spark, "p")
    rows = [(1, 1.5, "a", True), (2, float("nan"), None, None), (None, -3.0, "c", False), (4, None, "d", True)]
    spark.createDataFrame(rows, "i int, x double, s string, b boolean").repartition(3).write.parquet(path)
    plan = footer_plan(spark, [path])._jdf.queryExecution().toString()
    assert "PushedAggregation: [COUNT(*), COUNT(i)" in plan
    got = {r.column_name: (r.n_rows, r.n_missing, r.low, r.high) for r in stored_profile(spark, [path]).collect()}
    assert got == {"i": (4, 1, 1.0, 4.0), "x": (4, 2, -3.0, 1.5), "s": (4, 1, None, None), "b": (4, 1, None, None)}
    assert {r.column_name: r.n_missing for r in stored_profile(spark, [path], nan=False).collect()}["x"] == 1
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_sketches_of_parts_merge(spark):
    import numpy as np
    from orrery.operators.sketches import Sketches, distinct_error, rank_error, statistics, within_bounds
    from orrery.session import stage_path
    from orrery.sources.tables import Tables
    t = Tables(spark, stage_path(spark, "t"))
    s = Sketches(t, ["a", "b", "c"])
    x = np.random.RandomState(5).normal(size=30_000).round(4)
    rows = [(float(v), None if k % 3 else float(k % 100), None) for k, v in enumerate(x)]
    schema = "a double, b double, c double"
    t.load(spark.createDataFrame(rows[:20_000], schema), "x")
    assert s.refresh("x") == 1
    t.load(spark.createDataFrame(rows[20_000:], schema), "x")
    stats = statistics(s.of("x"))
    assert s.refresh("x") == 0
    got = {r.column_name: r for r in stats.collect()}
    assert [got[c].n_missing for c in "abc"] == [0, 20_000, 30_000] and got["c"].quantiles is None and got["c"].distinct == 0
    for p, q in zip((.25, .5, .75), got["a"].quantiles):
        assert abs((x < q).mean() - p) < rank_error() + 1e-3
    assert abs(got["a"].distinct / len(set(x.tolist())) - 1) < distinct_error()
    assert (got["a"].low, got["a"].high) == (x.min(), x.max())
    assert all(r.quantiles_hold and r.distinct_holds for r in within_bounds(t.read("x"), stats).collect())
    first = {r.column_name: r.n_rows for r in statistics(s.of("x", 0)).collect()}
    assert first == {"a": 20_000, "b": 20_000, "c": 20_000}
