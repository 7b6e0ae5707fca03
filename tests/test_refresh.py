"""What a refresh stores on the way, and the plans that come of it."""

from __future__ import annotations

from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.small_tables import CURRENT, gold, sale, silver
from tillroll.plans import activity, daily_sales, shop_dates
from tillroll.plans.refresh import Run, Store
from tillroll.sources import sinks
from tillroll.sources.tables import GoldTables, SilverTables

AS_OF = datetime(2001, 8, 1)
CUSTOMERS = [(10, "5", "h", None, CURRENT), (11, "6", "h", None, CURRENT)]


@pytest.fixture
def threshold(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "200000")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def store(spark, tmp_path):
    """Items in a wide table of several versions, larger than the threshold of broadcasts."""
    sales = [sale(date(2001, 7, d), txn=d, customer=10 + d % 2) for d in range(1, 28)]
    small = gold(spark, sales, CUSTOMERS)
    old = silver(spark, [(date(2001, 7, d), 10, 1, "Non-Ecomm Sale") for d in range(1, 28)], [(10, "5", CURRENT)])
    text = F.concat_ws("-", *[F.sha2(F.concat(F.lit(str(i)), F.col("id").cast("string")), 512) for i in range(4)])
    keys = spark.range(1, 5000)
    items = keys.select(F.col("id").alias("item_hk"), F.lit("Y").alias("current_financial_sale_flag"), text.alias("text"))
    versions = keys.select("id", F.lit("Y").alias("financial_sale_flag"), F.lit(CURRENT).alias("eff_to_dt"), text.alias("text"))
    tables = {"sales": small.retail_sale_fact, "items": items, "old_sales": old.retail_sale, "versions": versions}
    read = {name: sinks.stored(df, f"{tmp_path}/{name}") for name, df in tables.items()}
    return Store(
        GoldTables(read["sales"], small.location_dim, read["items"], small.register_dim, small.customer_dim),
        SilverTables(read["old_sales"], old.customer, read["versions"], old.location),
        AS_OF,
        f"{tmp_path}/out",
    )


def _shuffles_sales_by_item(df) -> bool:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "hashpartitioning(item_" in plan


def test_stored_keys_spare_the_facts_a_shuffle(spark, store, threshold, tmp_path):
    assert _shuffles_sales_by_item(daily_sales.pos_daily_agg_card(store.gold, AS_OF))
    assert _shuffles_sales_by_item(shop_dates.card_shop_dates(store.silver, AS_OF))
    run = Run(store, f"{tmp_path}/scratch")
    assert not _shuffles_sales_by_item(daily_sales.pos_daily_agg_card(run.gold, AS_OF))
    assert not _shuffles_sales_by_item(activity.card_transactions(run.gold, AS_OF))
    dates = shop_dates.card_shop_dates(store.silver, AS_OF, items=run.current_items, stores=run.current_stores)
    assert not _shuffles_sales_by_item(dates)
    assert dates.exceptAll(shop_dates.card_shop_dates(store.silver, AS_OF)).isEmpty()


def test_both_weekly_tables_come_from_one_table_of_histories(spark, store):
    tables = store.refresh(["card_transactions", "household_transactions"])
    cards = activity.card_transactions(store.gold, AS_OF)
    households = activity.household_transactions(cards, store.gold.customer_dim, AS_OF)
    for name, df in (("card_transactions", cards), ("household_transactions", households)):
        assert tables[name].count() == df.count() > 0
        assert tables[name].exceptAll(df).isEmpty()


def test_a_refresh_leaves_no_scratch_tables(spark, store):
    with sinks.scratch(spark) as folder:
        parent = Path(folder.removeprefix("file:")).parent
    before = set(parent.iterdir())
    store.refresh(["card_transactions", "card_shop_dates"])
    assert set(parent.iterdir()) == before
    with pytest.raises(ValueError):
        with sinks.scratch(spark) as folder:
            spark.range(3).write.parquet(folder)
            raise ValueError
    assert set(parent.iterdir()) == before
