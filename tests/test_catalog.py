"""Every registered query against its SQL, or for rows where SQL cannot say it."""

import pytest
from helpers import plan_text
from oracle import compare, connect

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_matches_sql(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    plan = plan_text(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "Pandas" not in plan
    assert compare(df, con, ORACLES[name]) == []


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_gives_rows(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert df.count() > 0
    assert len(set(df.columns)) == len(df.columns)


def test_entry(spark):
    df = entry.entry(spark)
    assert {"customer_id", "event_timestamp", "daily_total_minutes", "contract_type"} <= set(df.columns)
    assert df.limit(1).count() == 1


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
