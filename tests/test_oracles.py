"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import pytest

import __spark_entry__ as entry
from ledgerflow.plans.oracle import ORACLE
from ledgerflow.plans.registry import QUERIES
from oracle_compare import compare, duck

SMOKE = "/root/testdata/sf0.001"
SLOW = {"gbt_predict", "top_k_importance"}


@pytest.fixture(scope="module")
def con():
    return duck(SMOKE)


@pytest.mark.parametrize("name", sorted(set(ORACLE) - SLOW))
def test_query_matches_oracle(spark, con, name):
    problems = compare(QUERIES[name](spark, SMOKE), con, ORACLE[name])
    assert not problems, problems


def test_every_query_has_an_oracle_or_is_a_model():
    assert set(QUERIES) - set(ORACLE) <= SLOW
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "credit_limit" not in df.columns


@pytest.mark.parametrize("name", ["flatten_runs", "step_metrics", "parse_dates", "clean_payment"])
def test_results_do_not_depend_on_session_time_zone(spark, con, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        problems = compare(entry.queries()[name](spark, SMOKE), con, entry.oracle_sql()[name])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert not problems, problems
