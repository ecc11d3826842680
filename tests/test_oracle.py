"""Every registered query against its DuckDB SQL at sf0.01 (the driver's gate),
and a rows-only run of the queries without SQL."""

import pytest

import __spark_entry__ as E
from oracle_harness import compare, duck

SQL = E.oracle_sql()
SLOW = {"rf_fit_predict", "score_next_month"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, sf_dir, name):
    res = compare(spark, con, name, E.queries()[name], SQL[name], sf_dir)
    assert "error" not in res, res["error"]


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(SQL) - SLOW))
def test_rows_only_queries_run(spark, sf_dir, name):
    assert E.queries()[name](spark, sf_dir).count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["count", "ward_code", "date"] and df.count() > 0
