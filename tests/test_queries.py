"""Every query that has SQL gives the SQL's rows; a few others run and return rows."""

import pytest

import __spark_entry__ as entry_module
from check import compare, connect

SQL = entry_module.oracle_sql()
QUERIES = entry_module.queries()
RUN_ONLY = ["tune_grid", "fs_forward", "ens_stack", "score_batch", "score_stream", "stat_kmeans", "target_quantile_apply"]


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf, con, name):
    problem = compare(QUERIES[name](spark, sf), con, SQL[name])
    assert problem is None, problem


@pytest.mark.parametrize("name", RUN_ONLY)
def test_returns_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).limit(1).count() == 1


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_flagship_has_every_model(spark, sf):
    rows = QUERIES["met_comparison_models"](spark, sf).collect()
    assert {r["model"] for r in rows} == {"ridge", "lasso", "elasticnet", "bayesian_ridge", "stacking", "voting", "blend"}
    scores = [r["oof_rmsle"] for r in rows]
    assert scores == sorted(scores) and all(s > 0 for s in scores)
