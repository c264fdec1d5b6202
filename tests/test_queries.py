"""Registered queries against their SQL twins on the small tables.

By default the queries that need no scored feature table, and one of each kind
that does; set SLOTWISE_ALL=1 for every query.
"""

import os

import pytest

import __spark_entry__ as entry
from compare import compare, connect

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
ALL = os.environ.get("SLOTWISE_ALL") == "1"
KINDS = {"feature_table", "lag_features", "top3_drivers", "waterfall", "inference_run_linear", "bi_frontend"}


def chosen(name: str) -> bool:
    sql = ORACLES[name]
    return ALL or name in KINDS or not ("hist_" in sql or "scored_" in sql)


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES and chosen(n)])
def test_against_sql(spark, sf_dir, con, name):
    ok, message = compare(QUERIES[name], ORACLES[name], spark, sf_dir, con)
    assert ok, message


@pytest.mark.skipif(not ALL, reason="model fits; covered by test_models and test_runs")
@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
