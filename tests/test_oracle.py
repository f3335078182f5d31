"""Every registered query with an oracle statement agrees with DuckDB."""

import pytest

import __spark_entry__ as E
from orrery.plans.oracle import SQL
from orrery.plans.registry import QUERIES
from tests.conftest import SF_SMALL
from tools.check_oracle import duck, rows_of

KEYS = sorted(set(SQL) & set(QUERIES))


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    sdf = QUERIES[key](spark, SF_SMALL)
    res = con.execute(SQL[key])
    d_cols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(d_cols)
    assert rows_of(sdf.columns, [tuple(r) for r in sdf.collect()]) == rows_of(d_cols, res.fetchall())


def test_every_query_has_entry_or_is_rows_only():
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())
    assert set(QUERIES) - set(SQL) == {"score_batch", "lof_catalog", "grid_search"}


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["class", "data_split", "n_rows"]
    assert df.count() > 0
