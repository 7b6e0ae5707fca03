"""A customer, day or key that holds a large share of all rows must not reach one task row by row."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.small_tables import CURRENT, gold, silver
from tillroll.operators import quality
from tillroll.operators.spans import flag_in_window
from tillroll.operators.versions import latest_version
from tillroll.operators.skew import SPREAD, busy_keys, join_spread
from tillroll.plans.activity import card_transactions, household_transactions_from_sales
from tillroll.plans.daily_sales import pos_daily_agg_card, pos_daily_agg_hhn
from tillroll.plans.shop_dates import card_shop_dates, household_shop_dates
from tillroll.sources.tables import GoldTables, SilverTables

AS_OF = datetime(2001, 8, 1)
ROWS, PARTITIONS = 60_000, 4
CUSTOMERS = [(10, "5", "h", None, CURRENT), (11, "6", "h", None, CURRENT), (99, "0", None, None, CURRENT)]


@pytest.fixture(scope="module")
def adaptive_off(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")


def _shuffled(df) -> list[int]:
    """Rows written by each shuffle of an executed query, nearest to the result first."""
    fresh = df.select("*")  # a plan of its own: shuffle files of an earlier run would be reused
    fresh.collect()
    found = []

    def visit(node):
        if node.nodeName() == "Exchange":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))

    visit(fresh._jdf.queryExecution().executedPlan())
    assert max(found) > 0
    return found


@pytest.fixture(scope="module")
def hot_facts(spark):
    """A third of the sales by one card, a third anonymous, the rest spread; one transaction per four rows."""
    i = F.col("id")
    return spark.range(0, ROWS, 1, PARTITIONS).select(
        F.date_add(F.lit(date(1999, 1, 3)), (i / 64 % 900).cast("int")).alias("fiscal_date"),
        (i / 4).cast("bigint").alias("transaction_number"),
        F.when(i % 3 == 0, 10).when(i % 3 == 1, 99).otherwise(i % 50 + 100).cast("bigint").alias("customer_hk"),
        F.lit(1).cast("bigint").alias("location_hk"),
        F.lit(1).cast("bigint").alias("item_hk"),
        F.lit(1).alias("register_hk"),
        F.lit("Non-Ecomm Sale").alias("ecomm_flag"),
        F.lit(1).cast("decimal(18,2)").alias("merch_sales"),
        F.lit(None).cast("decimal(18,2)").alias("merch_scan_margin"),
        F.lit(1).cast("bigint").alias("unit_count"),
        F.lit(1).alias("item_count"),
    )


def _gold(spark, facts) -> GoldTables:
    small = gold(spark, [], CUSTOMERS)
    return GoldTables(facts, small.location_dim, small.item_dim, small.register_dim, small.customer_dim)


def test_card_activity_shuffles_a_few_rows_per_customer(spark, adaptive_off, hot_facts):
    df = card_transactions(_gold(spark, hot_facts.filter("customer_hk < 100")), AS_OF)
    assert df.count() > 100
    # 40,000 sales of two customers over 29 months (five blocks of 32 weeks) in four input partitions.
    assert max(_shuffled(df)) <= 2 * 5 * PARTITIONS


def test_shop_dates_shuffle_two_dates_per_banner_and_channel(spark, adaptive_off, hot_facts):
    small = silver(spark, [], [(10, "5", CURRENT)])
    sales = hot_facts.filter("customer_hk = 10").select(
        F.col("fiscal_date").cast("timestamp_ntz").alias("fiscal_date"),
        F.col("customer_hk").alias("customer_id"),
        F.col("location_hk").alias("store_number"),
        "ecomm_flag",
        F.col("item_hk").alias("item_id"),
    )
    df = card_shop_dates(SilverTables(sales, small.customer, small.item, small.location), AS_OF)
    row = df.collect()[0]
    assert row.sof_only_instore_first_shop_date == date(1999, 1, 3)
    assert max(_shuffled(df)) <= PARTITIONS * 2


def test_daily_sales_spread_a_customer_over_transactions(spark, adaptive_off, hot_facts):
    one_key = hot_facts.withColumn("fiscal_date", F.lit(date(2001, 7, 20))).withColumn("customer_hk", F.lit(99))
    df = pos_daily_agg_card(_gold(spark, one_key), AS_OF)
    row = df.collect()[0]
    assert (row.transaction_count, row["items"]) == (ROWS // 4, ROWS)
    final, by_transaction = _shuffled(df)[:2]
    assert by_transaction == ROWS // 4
    assert final <= int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_busy_key_is_spread_where_it_meets_its_dimension(spark, adaptive_off, no_broadcast, hot_facts):
    rows = hot_facts.select("customer_hk", "fiscal_date", "transaction_number")
    names = hot_facts.select("customer_hk").distinct().withColumn("name", F.concat(F.lit("n"), "customer_hk"))
    assert sorted(r.customer_hk for r in busy_keys(rows, "customer_hk").collect() if r.customer_hk < 100) == [10, 99]
    joined = join_spread(rows, names, "customer_hk", ["fiscal_date", "transaction_number"])
    assert joined.exceptAll(rows.join(names, "customer_hk").select(*joined.columns)).isEmpty() and joined.count() == ROWS
    tasks = [r["count"] for r in joined.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()]
    plain = rows.join(names, "customer_hk").withColumn("task", F.spark_partition_id()).groupBy("task").count()
    # Each of the two hot keys holds a third of the rows, and lands in one task where it is not spread.
    assert max(r["count"] for r in plain.collect()) >= ROWS // 3
    assert max(tasks) < 1.5 * ROWS / int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_spread_join_without_busy_keys_rows_or_partners(spark):
    many = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert busy_keys(many, "k").isEmpty() and busy_keys(many.limit(0), "k").isEmpty()
    half = many.filter("k % 2 = 0").select("k", F.lit("x").alias("name"))
    assert join_spread(many, half, "k", ["v"]).count() == 2500
    assert join_spread(many.limit(0), half, "k", ["v"]).count() == 0
    empty_key = spark.createDataFrame([(None, 1), (3, 2), (3, 3)], "k bigint, v bigint")
    assert sorted((r.k, r.v) for r in join_spread(empty_key, many.select("k"), "k", ["v"]).collect()) == [(3, 2), (3, 3)]


def test_daily_household_sales_spread_the_anonymous_card(spark, adaptive_off, no_broadcast, hot_facts):
    i = F.col("transaction_number")
    spread = hot_facts.filter("customer_hk in (10, 99)").withColumn("location_hk", i % 100).withColumn("fiscal_date", F.lit(date(2001, 7, 1)))
    cards = spread.groupBy("fiscal_date", "customer_hk", "location_hk").agg(F.lit("In Store").alias("channel"), *[F.count("*").alias(c) for c in ("transaction_count", "sales", "scan", "units", "items")])
    customers = gold(spark, [], CUSTOMERS).customer_dim
    df = pos_daily_agg_hhn(cards, customers, AS_OF)
    assert {r.hhn: r.total for r in df.groupBy("hhn").agg(F.sum("items").alias("total")).collect()} == {"h": ROWS // 3, None: ROWS // 3}
    # The two busy versions of the dimension are repeated; Spark drops the third, which has no rows.
    assert 2 * SPREAD in _shuffled(df)


def test_household_shop_dates_shuffle_one_row_per_household(spark, adaptive_off):
    small = silver(spark, [(date(2001, 7, 1), 10, 1, "Non-Ecomm Sale")], [(10, "5", CURRENT)])
    one = card_shop_dates(small, AS_OF).drop("card_number")
    cards = spark.range(0, 4000, 1, PARTITIONS).select(F.col("id").cast("string").alias("card_number"))
    versions = [(k, str(k), "h", None, CURRENT) for k in range(1, 4000)]
    df = household_shop_dates(cards.join(F.broadcast(one)), gold(spark, [], versions).customer_dim, AS_OF)
    assert [r.sof_instore_first_shop_date for r in df.collect()] == [date(2001, 7, 1)]
    # Memberships are made distinct by card; the household's 3,999 cards arrive as one row per task.
    assert _shuffled(df)[0] <= max(PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))


def test_household_activity_shuffles_blocks_of_a_household(spark, adaptive_off, hot_facts):
    facts = hot_facts.filter("customer_hk >= 100")
    versions = [(k, str(k), "h", None, CURRENT) for k in range(100, 150)]
    small = gold(spark, [], versions)
    df = household_transactions_from_sales(GoldTables(facts, small.location_dim, small.item_dim, small.register_dim, small.customer_dim), AS_OF)
    assert df.count() > 50
    # 50 cards of one household: six blocks for each task before the merge, whatever the number of weeks.
    assert _shuffled(df)[0] <= 6 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_latest_version_sends_one_row_per_partition(spark, adaptive_off):
    versions = spark.range(0, ROWS, 1, PARTITIONS).select(
        (F.col("id") % 1).cast("string").alias("card_number"),
        F.col("id").alias("customer_hk"),
        F.date_add(F.lit(date(1900, 1, 1)), (F.col("id") % 30_000).cast("int")).alias("eff_to_dt"),
    )
    df = latest_version(versions, ["card_number"], tie_breakers=["customer_hk"])
    assert [r.customer_hk for r in df.collect()] == [59_999]
    assert _shuffled(df) == [PARTITIONS]


def test_window_flags_see_each_day_of_a_key_once(spark, adaptive_off, hot_facts):
    spine = spark.createDataFrame([(10, date(1999, 1, 3), date(1999, 1, 30))], "customer_hk bigint, lo date, hi date")
    events = hot_facts.filter("customer_hk = 10").select("customer_hk", "fiscal_date")
    df = flag_in_window(spine, events, "customer_hk", "fiscal_date", "lo", "hi", "hit")
    assert df.count() == 1
    # 20,000 sales on 938 runs of days, a run that crosses a partition border counting twice.
    assert max(_shuffled(df)) <= 938 + PARTITIONS


def test_side_comparison_sends_one_row_per_key_and_partition(spark, adaptive_off, hot_facts):
    keys = hot_facts.filter("customer_hk < 100").select("customer_hk")
    df = quality.compare_sides(keys, keys, ["customer_hk"])
    assert df.count() == 2
    assert max(_shuffled(df)) <= 2 * 2 * PARTITIONS
