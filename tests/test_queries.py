"""Every registered query against its SQL twin, and the shape of the plans that matter at scale."""

from __future__ import annotations

import importlib
import re
from datetime import datetime

import duckdb
import pytest

from oracles.retail_sql import ORACLES as RETAIL_ORACLES
from tillroll.catalogue import QUERIES

SF = "/root/testdata/sf0.001"
ENTRY = importlib.import_module("__spark_entry__")
ORACLES = ENTRY.oracle_sql()
RAW = ["orders", "lineitem", "customer", "supplier", "part"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in RAW:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return connection


def _key(row):
    return tuple(repr(value.isoformat() if isinstance(value, datetime) else value) for value in row)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(RETAIL_ORACLES)
    assert set(QUERIES) <= set(ENTRY.queries())
    assert set(ORACLES) <= set(ENTRY.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    found = sorted(_key(row) for row in df.select(*columns).collect())
    expected = sorted(_key(row) for row in cursor.fetchall())
    assert found == expected


def test_entry_returns_the_flagship_query(spark):
    df = ENTRY.entry(spark)
    assert df.columns[:2] == ["card_number", "week_end_date"]
    assert not df.isEmpty()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"dq_report", "dq_counted_while_written", "dq_row_differences", "sink_partitioned_roundtrip", "daily_sales_of_changed_days"}))
def test_no_query_pairs_rows_without_a_key(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan)
    assert "Python" not in plan


def test_date_bounds_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    for name, first_day in (("pos_daily_agg_card", True), ("card_transactions", True), ("card_shop_dates", False)):
        pushed = re.findall(r"PushedFilters: \[[^\]]*", _plan(QUERIES[name](spark, SF)))
        assert any(re.search(r"LessThan(OrEqual)?\(o_orderdate,2001-07-2[89]", p) for p in pushed), pushed
        assert not first_day or any(re.search(r"GreaterThan(OrEqual)?\(o_orderdate,199\d-", p) for p in pushed), pushed
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_card_activity_reduces_facts_before_customers_are_joined(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(QUERIES["card_transactions"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    customer_join = next(i for i, line in enumerate(lines) if "SortMergeJoin [customer_hk" in line)
    partial = next(i for i, line in enumerate(lines) if "HashAggregate(keys=[customer_hk" in line)
    item_join = next(i for i, line in enumerate(lines) if "SortMergeJoin [item_hk" in line)
    assert customer_join < partial < item_join


def test_latest_version_limits_groups_before_the_shuffle(spark):
    plan = _plan(QUERIES["scd_latest_by_card"](spark, SF))
    assert re.search(r"WindowGroupLimit .* Partial", plan)
