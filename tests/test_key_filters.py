"""Facts without a partner are dropped before the shuffle of a join that is too large to broadcast."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.small_tables import gold
from tests.test_hot_keys import _shuffled
from tillroll.operators.key_filters import SETTINGS, key_filters
from tillroll.plans.daily_sales import daily_facts
from tillroll.sources import sinks
from tillroll.sources.tables import GoldTables

AS_OF = datetime(2001, 8, 1)
ROWS, ITEMS, FINANCIAL = 60_000, 20_000, 1_000


@pytest.fixture
def large_joins(spark):
    """Trial data stand for large ones: nothing is broadcast, and no facts are too few."""
    trial = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    }
    for key, value in trial.items():
        spark.conf.set(key, value)
    yield
    for key in trial:
        spark.conf.unset(key)


@pytest.fixture
def tables(spark, tmp_path):
    small = gold(spark, [], [])
    facts = spark.range(0, ROWS, 1, 4).select(
        F.lit(date(2001, 7, 1)).alias("fiscal_date"),
        F.col("id").alias("transaction_number"),
        F.lit(10).cast("bigint").alias("customer_hk"),
        F.lit(1).cast("bigint").alias("location_hk"),
        (F.col("id") % ITEMS).alias("item_hk"),
    )
    flag = F.when(F.col("item_hk") < FINANCIAL, "Y").otherwise("N").alias("current_financial_sale_flag")
    items = spark.range(ITEMS).select(F.col("id").alias("item_hk")).select("item_hk", flag)
    stores = sinks.stored(small.location_dim, f"{tmp_path}/stores")
    return GoldTables(sinks.stored(facts, f"{tmp_path}/facts"), stores, sinks.stored(items, f"{tmp_path}/items"), small.register_dim, small.customer_dim)


def test_facts_of_other_items_are_not_shuffled(spark, large_joins, tables):
    wanted = ROWS * FINANCIAL // ITEMS

    def moved() -> tuple[str, int, list]:
        df = daily_facts(tables, AS_OF).groupBy("location_hk").agg(F.count("*").alias("n"), F.sum("transaction_number").alias("s"))
        return df._jdf.queryExecution().optimizedPlan().toString(), max(_shuffled(df)), df.collect()

    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", "false")
    try:
        _, rows_without, without = moved()
    finally:
        spark.conf.unset("spark.sql.optimizer.runtime.bloomFilter.enabled")
    with key_filters(spark):
        plan, rows, found = moved()
    assert "might_contain" in plan and "item_hk" in plan
    assert rows_without == ROWS
    # The join with stores and that with items move the facts that pass, the latter filter included.
    assert wanted <= rows <= 1.2 * wanted + ITEMS // 20
    assert found == without and found[0].n == wanted


def test_settings_of_the_session_stay(spark):
    key = next(key for key in SETTINGS if key.endswith("creationSideThreshold"))
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    spark.conf.set(key, "5m")
    try:
        with key_filters(spark):
            assert spark.conf.get(key) == "5m"
            assert all(spark.conf.get(k) == v for k, v in SETTINGS.items() if k != key)
    finally:
        spark.conf.unset(key)
    assert {k: spark.conf.get(k, None) for k in SETTINGS} == before
