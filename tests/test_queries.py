"""Every registered query against DuckDB over the same tables."""

import glob
import os

import duckdb
import pytest
from conftest import SMOKE, in_order

import __spark_entry__ as driver
from carestrata.plans.oracle import all_sql
from carestrata.plans.queries import all_queries

QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SMOKE}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry_offers_every_query():
    assert set(QUERIES) <= set(driver.queries()) and set(SQL) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SMOKE)
    columns = sorted(df.columns)
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = [tuple(r[i] for i in order) for r in cursor.fetchall()]
    assert in_order(got) == in_order(expected)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_eras_shuffle_twice_beyond_their_input(spark):
    """Both passes of the drug eras run on one partitioning by person and ingredient."""
    plan = QUERIES["drug_era_gap_180"](spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(person_id") == 2


def test_scans_read_needed_columns_only(spark):
    plan = QUERIES["event_eras_gap_1"](spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema: ")[1].split(">")[0]
    assert "props" not in schema and "event_id" not in schema
