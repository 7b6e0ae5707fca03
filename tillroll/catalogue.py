"""The registered queries: every operator and plan over one folder of test tables.

Money is exact decimal in the library; the queries hand it out as double so that results from
different engines compare by value.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import domain
from tillroll.functions import calendar, retail
from tillroll.operators import distinct_sets, quality, skew, spans
from tillroll.operators.fingerprints import row_differences
from tillroll.operators.intervals import interval_join
from tillroll.operators.key_filters import key_filters
from tillroll.operators.versions import latest_version
from tillroll.plans import activity, checks, daily_sales, household_types, increment, refresh, shop_dates
from tillroll.sources import footers, sinks, star

AS_OF = datetime(2001, 8, 1)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _money_as_double(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("double") for name in columns})


def _raw(spark: SparkSession, sf_dir: str) -> star.RawTables:
    return star.RawTables(spark, sf_dir)


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.customer_dim(_raw(spark, sf_dir))


def _order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("run_date"))


# --- the seven tables -------------------------------------------------------------------------


@query
def pos_daily_agg_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _money_as_double(daily_sales.pos_daily_agg_card(star.gold(spark, sf_dir), AS_OF), "sales", "scan")


@query
def pos_daily_agg_hhn(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = star.gold(spark, sf_dir)
    card_daily = daily_sales.pos_daily_agg_card(gold, AS_OF)
    # One narrow pass over the sales finds the busy versions, so the daily rows are worked out once.
    busy = skew.busy_keys(_raw(spark, sf_dir).orders, "o_custkey").withColumnRenamed("o_custkey", "customer_hk")
    return _money_as_double(daily_sales.pos_daily_agg_hhn(card_daily, gold.customer_dim, AS_OF, busy=busy), "sales", "scan")


@query
def card_shop_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shop_dates.card_shop_dates(star.silver(spark, sf_dir), AS_OF)


@query
def household_shop_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    card_dates = shop_dates.card_shop_dates(star.silver(spark, sf_dir), AS_OF)
    return shop_dates.household_shop_dates(card_dates, _customers(spark, sf_dir), AS_OF)


@query
def card_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.card_transactions(star.gold(spark, sf_dir), AS_OF)


@query
def household_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = star.gold(spark, sf_dir)
    histories = activity.card_histories(gold, calendar.WeeklyBounds.of(AS_OF.date()))
    return activity.household_flags(histories, gold.customer_dim, AS_OF)


@query
def household_transactions_from_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the weekly rows of the card table."""
    gold = star.gold(spark, sf_dir)
    return activity.household_transactions(activity.card_transactions(gold, AS_OF), gold.customer_dim, AS_OF)


@query
def household_transactions_from_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.household_transactions_from_sales(star.gold(spark, sf_dir), AS_OF)


@query
def household_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return household_types.household_type(_customers(spark, sf_dir), AS_OF)


# --- projections, filters, expressions --------------------------------------------------------


@query
def project_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = star.gold(spark, sf_dir).retail_sale_fact
    return fact.select("fiscal_date", "location_hk", "customer_hk", "item_hk", "ecomm_flag")


@query
def audit_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retail.stamped(_customers(spark, sf_dir), AS_OF, "dl_load_dt", "dl_update_dt")


@query
def filter_isin(spark: SparkSession, sf_dir: str) -> DataFrame:
    banners = (*domain.SOF_BANNERS, *domain.BLF_BANNERS)
    return star.gold(spark, sf_dir).location_dim.filter(
        F.col("current_banner_short_name").isin(*banners) & F.col("location_type").isin(*domain.LOCATION_TYPES)
    )


@query
def filter_financial_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_sales.financial_items(star.gold(spark, sf_dir).item_dim)


@query
def filter_sentinel_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.identified_cards(_customers(spark, sf_dir))


@query
def filter_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = calendar.DailyBounds.of(AS_OF.date())
    fact = star.gold(spark, sf_dir).retail_sale_fact
    return fact.filter(F.col("fiscal_date").between(bounds.first_day, bounds.last_day)).select(
        "fiscal_date", "transaction_number", "customer_hk"
    )


@query
def channel_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    channel = retail.sales_channel(F.col("ecomm_flag"), F.col("id"))
    return _with_register(spark, sf_dir).select("transaction_number", "ecomm_flag", "id", channel.alias("channel"))


@query
def hh_type_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    card_type = retail.recode(F.col("current_card_type"), domain.CARD_TYPE_ALIASES)
    return _customers(spark, sf_dir).select(
        "customer_hk", "current_card_type", retail.household_type(card_type, F.lit(1)).alias("hh_type")
    )


@query
def cast_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _raw(spark, sf_dir).orders.select("o_orderkey", F.col("o_orderdate").cast("string").alias("o_orderdate"))
    return retail.cast_timestamps(texts, ["o_orderdate"])


@query
def last_saturday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_days(spark, sf_dir).withColumn("last_saturday", calendar.last_saturday_of(F.col("run_date")))


@query
def last_sunday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_days(spark, sf_dir).withColumn("last_sunday", calendar.last_sunday_of(F.col("run_date")))


@query
def calendar_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    weeks = _order_days(spark, sf_dir).withColumn("week_end_date", calendar.week_end_of(F.col("run_date")))
    return weeks.withColumns(calendar.window_dates(F.col("week_end_date")))


@query
def calendar_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _order_days(spark, sf_dir)
    run_date = F.col("run_date")
    return days.withColumns({**calendar.daily_bounds_of(run_date), **calendar.weekly_bounds_of(run_date)})


@query
def overall_first_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = [name for name in domain.shop_date_columns() if name.startswith("pfg_")]
    return shop_dates.card_shop_dates(star.silver(spark, sf_dir), AS_OF).select("card_number", *dates)


# --- joins ------------------------------------------------------------------------------------


def _with_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = star.gold(spark, sf_dir)
    return gold.retail_sale_fact.join(gold.register_dim, "register_hk", "left")


@query
def join_inner_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = star.gold(spark, sf_dir)
    return gold.retail_sale_fact.join(gold.location_dim, "location_hk").select(
        "transaction_number", "location_hk", "current_banner_short_name", "location_type"
    )


@query
def join_inner_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = star.gold(spark, sf_dir)
    items = daily_sales.financial_items(gold.item_dim)
    return gold.retail_sale_fact.join(items, "item_hk").select("transaction_number", "item_hk")


@query
def join_inner_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = star.gold(spark, sf_dir)
    return gold.retail_sale_fact.join(gold.customer_dim, "customer_hk").select(
        "transaction_number", "customer_hk", "card_number", "current_household_id"
    )


@query
def join_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = star.gold(spark, sf_dir).retail_sale_fact
    days = calendar.calendar_of(fact, "fiscal_date")
    return fact.join(days, fact["fiscal_date"] == days["date"]).select(
        "transaction_number", "fiscal_date", "week_end_date"
    )


@query
def join_left_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_register(spark, sf_dir).select("transaction_number", "register_hk", "id")


def _card_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days on which identified cards made qualifying sales, by banner and channel, with their week.

    Sales shrink to such days per customer version before customers are joined."""
    gold = star.gold(spark, sf_dir)
    bounds = calendar.WeeklyBounds.of(AS_OF.date())
    cards = activity.identified_cards(gold.customer_dim).select("customer_hk", "card_number")
    days = ["customer_hk", "fiscal_date", "current_banner_short_name", "ecomm_flag"]
    sales = activity.weekly_facts(gold, bounds).select(*days).distinct().join(cards, "customer_hk")
    return sales.withColumn("week_end_date", calendar.week_end_of(F.col("fiscal_date")))


def _shopping_weeks(sales: DataFrame) -> DataFrame:
    first_week = calendar.WeeklyBounds.of(AS_OF.date()).card_first_week
    return sales.filter(F.col("week_end_date") >= first_week).select("card_number", "week_end_date").distinct()


def _spread(sales: DataFrame) -> DataFrame:
    last_day = F.lit(calendar.last_saturday(AS_OF.date()))
    return spans.spread_weeks(_shopping_weeks(sales), "card_number", "week_end_date", domain.SPREAD_WEEKS, last_day)


def _flag(sales: DataFrame, series: str, window: str) -> DataFrame:
    """One flag by the general range semi-join, on the spread weeks."""
    group, channel = series.split("_")
    dates = calendar.window_dates(F.col("week_end_date"))
    spine = _spread(sales).select(
        "card_number",
        "week_end_date",
        dates[f"{window}_start_dt"].alias("start_dt"),
        dates.get(f"{window}_end_dt", F.col("week_end_date")).alias("end_dt"),
    )
    sold = F.col("current_banner_short_name").isin(*domain.BANNER_GROUPS[group]) & (
        F.col("ecomm_flag") == domain.FLAG_CHANNELS[channel]
    )
    name = f"{series}_{window}_flag"
    flagged = spans.flag_in_window(spine, sales, "card_number", "fiscal_date", "start_dt", "end_dt", name, sold)
    return flagged.select("card_number", "week_end_date", name)


@query
def distinct_card_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shopping_weeks(_card_sales(spark, sf_dir))


@query
def range_join_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spread(_card_sales(spark, sf_dir))


@query
def semi_join_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flag(_card_sales(spark, sf_dir), "sof_instore", "prior_13wk")


@query
def join_left_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = _card_sales(spark, sf_dir)
    flagged = _flag(sales, "blf_ecomm", "current_4wk")
    flag = flagged.columns[-1]
    widened = _spread(sales).join(flagged, ["card_number", "week_end_date"], "left")
    return widened.withColumn(flag, F.coalesce(F.col(flag), F.lit(0)))


@query
def join_right_all_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = star.silver(spark, sf_dir)
    last_day = calendar.last_saturday(AS_OF.date())
    dates = shop_dates.customer_shop_dates(silver, last_day).select("customer_id", "qf_only_ecom_last_shop_date")
    cards = shop_dates.current_cards(silver.customer)
    return cards.join(dates, cards["ldw_customer_id"] == dates["customer_id"], "left").drop("customer_id")


@query
def join_latest_subquery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Households of the cards that shopped, by SQL over views."""
    return spark.sql(
        """
        WITH newest AS (
            SELECT card_number, current_household_id AS hhn,
                   row_number() OVER (PARTITION BY card_number ORDER BY eff_to_dt DESC, customer_hk DESC) AS version
            FROM {versions}
        )
        SELECT w.card_number, w.week_end_date, n.hhn
        FROM {weeks} w JOIN newest n ON w.card_number = n.card_number AND n.version = 1
        """,
        versions=_customers(spark, sf_dir),
        weeks=_shopping_weeks(_card_sales(spark, sf_dir)),
    )


@query
def interval_join_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stores' campaigns, of up to 400 days, and the activity windows of all weeks that they overlap."""
    raw = _raw(spark, sf_dir)
    sold = star.retail_sale_fact(raw).groupBy("location_hk").agg(F.min("fiscal_date").alias("first"), F.max("fiscal_date").alias("last"))
    opening = F.struct(
        F.lit("opening").alias("campaign"), F.col("first").alias("from_day"),
        F.date_add("first", (F.col("location_hk") % 60).cast("int")).alias("to_day"),
    )
    closing = F.struct(
        F.lit("closing").alias("campaign"), F.date_sub("last", (F.col("location_hk") % 400).cast("int")).alias("from_day"),
        F.col("last").alias("to_day"),
    )
    campaigns = sold.select("location_hk", F.explode(F.array(opening, closing)).alias("c")).select("location_hk", "c.*")
    weeks = _order_days(spark, sf_dir).select(calendar.week_end_of(F.col("run_date")).alias("week_end_date")).distinct()
    dates = calendar.window_dates(F.col("week_end_date"))
    windows = [
        F.struct(
            F.lit(name).alias("activity_window"), dates[f"{name}_start_dt"].alias("start_dt"),
            dates.get(f"{name}_end_dt", F.col("week_end_date")).alias("end_dt"),
        )
        for name in domain.ACTIVITY_WINDOWS
    ]
    looks = weeks.select("week_end_date", F.explode(F.array(*windows)).alias("w")).select("week_end_date", "w.*")
    pairs = interval_join(campaigns, looks, ("from_day", "to_day"), ("start_dt", "end_dt"))
    return pairs.select("location_hk", "campaign", "week_end_date", "activity_window")


LONG_WINDOWS = {"last_52wk": (0, 51), "prior_52wk": (52, 103), "last_104wk": (0, 103)}


@query
def card_activity_two_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity flags over windows of a year and of two, from bitmaps of five words."""
    bounds = calendar.WeeklyBounds.of(AS_OF.date())
    return activity.activity_in_windows(star.gold(spark, sf_dir), bounds, LONG_WINDOWS)


@query
def household_activity_two_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = calendar.WeeklyBounds.of(AS_OF.date())
    return activity.activity_in_windows(star.gold(spark, sf_dir), bounds, LONG_WINDOWS, by_household=True)


# --- aggregates, windows, versions ------------------------------------------------------------


@query
def agg_count_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = star.gold(spark, sf_dir).retail_sale_fact
    return fact.groupBy("location_hk").agg(F.count_distinct("transaction_number").alias("transaction_count"))


@query
def distinct_transactions_by_household(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted from stored sets of each customer's transactions, not from the sales again."""
    gold = star.gold(spark, sf_dir)
    cards = distinct_sets.distinct_sets(gold.retail_sale_fact, ["customer_hk", "location_hk"], "transaction_number")
    kept = sinks.stored(cards, sinks.scratch_folder(spark))
    households = gold.customer_dim.select("customer_hk", F.col("current_household_id").alias("hhn"))
    of_household = skew.join_spread(kept, households, "customer_hk", ["location_hk", distinct_sets.BLOCK])
    return distinct_sets.set_sizes(of_household, ["hhn"], "transaction_count")


@query
def agg_sum_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = star.gold(spark, sf_dir).retail_sale_fact
    scans = fact.groupBy("customer_hk").agg(F.sum(F.coalesce("merch_scan_margin", F.lit(0))).alias("scan"))
    return _money_as_double(scans, "scan")


@query
def scd_latest_by_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.household_of_card(_customers(spark, sf_dir))


@query
def scd_latest_by_card_household(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _customers(spark, sf_dir)
    return latest_version(customers, ["card_number", "current_household_id"], tie_breakers=["customer_hk"])


@query
def scd_latest_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_version(star.silver(spark, sf_dir).item, ["id"], tie_breakers=["financial_sale_flag"])


@query
def scd_latest_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_version(star.silver(spark, sf_dir).location, ["id"], tie_breakers=["banner_short_name", "location_type"])


@query
def window_count_card_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = household_types.household_card_types(_customers(spark, sf_dir))
    return household_types.with_card_type_count(types)


# --- sinks and data quality -------------------------------------------------------------------


@query
def sink_partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the card activity table partitioned by week, read back its last 13 weeks."""
    flags = activity.card_transactions(star.gold(spark, sf_dir), AS_OF)
    back = sinks.stored(flags, f"{sinks.scratch_folder(spark)}/card_transactions", "week_end_date")
    last_week = F.lit(calendar.last_saturday(AS_OF.date()))
    return back.filter(F.col("week_end_date").between(F.date_sub(last_week, 12 * 7), last_week))


@query
def daily_sales_of_changed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily card table built from former sales, then brought up to date for the days that changed."""
    base = sinks.scratch_folder(spark)
    raw = star.RawTables(spark, sf_dir, base)
    gold, silver = star.gold_of(raw), star.silver_of(raw)
    day = F.dayofyear("fiscal_date")
    corrected = (day % 31 == 3).cast("bigint")
    former = gold.retail_sale_fact.where(day % 29 != 5).withColumn("unit_count", F.col("unit_count") + corrected)
    increment.refresh_daily(refresh.Store(replace(gold, retail_sale_fact=former), silver, AS_OF, base))
    store = refresh.Store(gold, silver, AS_OF + timedelta(hours=6), base)
    increment.refresh_daily(store)
    daily = store.table("pos_daily_agg_card").withColumn("rebuilt", F.col("dl_load_dt") > F.lit(AS_OF))
    return _money_as_double(daily.drop("dl_load_dt", "dl_update_dt"), "sales", "scan")


@query
def dq_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = household_types.household_types(_customers(spark, sf_dir))
    return quality.duplicate_keys(types, domain.TABLE_KEYS["household_type"])


@query
def dq_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = star.gold(spark, sf_dir)
    inputs = quality.null_counts(gold.retail_sale_fact, ["ecomm_flag", "merch_sales", "merch_scan_margin"])
    daily = daily_sales.pos_daily_agg_card(gold, AS_OF)
    outputs = quality.null_counts(daily, ["transaction_count", "sales", "scan", "units", "items"])
    types = quality.null_counts(household_types.household_types(gold.customer_dim), ["hhn", "hh_type"])
    return reduce(DataFrame.unionByName, [inputs, outputs, types])


@query
def dq_flag_implication(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = activity.card_transactions(star.gold(spark, sf_dir), AS_OF)
    return quality.implication_counts(flags, checks.flag_implications())


@query
def dq_missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Households of identified cards that have no weekly activity, as keys missing in the table."""
    gold = star.gold(spark, sf_dir)
    active = activity.household_transactions_from_sales(gold, AS_OF)
    return quality.missing_in_target(checks.identified_households(gold.customer_dim), active, ["hhn"])


@query
def dq_distinct_count_recon(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = star.gold(spark, sf_dir)
    daily = daily_sales.pos_daily_agg_card(gold, AS_OF)
    source = checks.sold_to(gold, AS_OF, "card_number")
    return quality.reconcile(source, checks.cards_in(daily, gold.customer_dim), ["card_number"])


@query
def dq_row_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _customers(spark, sf_dir)
    recomputed = checks.household_types_recomputed(customers)
    return quality.reconcile(recomputed, household_types.household_types(customers), ["hhn", "hh_type"])


@query
def dq_row_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored daily table against one with altered and missing rows, by fingerprints of key ranges."""
    measures = ["transaction_count", "units", "items"]
    keys = domain.TABLE_KEYS["pos_daily_agg_card"]
    daily = daily_sales.pos_daily_agg_card(star.gold(spark, sf_dir), AS_OF).select(*keys, *measures)
    kept = sinks.stored(daily, sinks.scratch_folder(spark))
    altered = kept.where("customer_hk % 97 <> 5").withColumn("units", F.col("units") + (F.col("customer_hk") % 89 == 3).cast("int"))
    return row_differences(kept, altered, [*keys, *measures], keys)


@query
def dq_counted_while_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and violations of row checks, counted while two tables were stored; no table is read for it."""
    gold, silver = star.gold(spark, sf_dir), star.silver(spark, sf_dir)
    with sinks.scratch(spark) as base:
        counts = refresh.Store(gold, silver, AS_OF, base).refresh_counting(["pos_daily_agg_card", "card_transactions"])
    rows = [(table, metric, int(value)) for table, metrics in counts.items() for metric, value in metrics.items()]
    return spark.createDataFrame(rows, "table_name string, metric string, value bigint")


@query
def dq_deviating_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by year, some years stored with other columns; a merged read of the table shows none of it."""
    orders = _raw(spark, sf_dir).orders.select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("double"), F.year("o_orderdate").alias("year"), "o_orderstatus")
    usual = ["o_orderkey", "o_custkey", "o_totalprice"]
    odd = {1996: [*usual[:2], "string(o_totalprice) AS o_totalprice"], 1997: usual[::-1], 1998: usual[::2], 1999: [*usual, "o_orderstatus"]}
    folder = sinks.scratch_folder(spark)
    sinks.write_table(orders.where(~F.col("year").isin(*odd)).select(*usual, "year"), folder, "year")
    for year, columns in odd.items():
        sinks.write_table(orders.where(F.col("year") == year).selectExpr(*columns), f"{folder}/year={year}")
    found = footers.deviating_layouts(footers.stored_layouts(spark, folder), usual)
    return found.select("partition", "missing", "extra", "misplaced", "retyped").distinct()


@query
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refresh and store all seven tables, then run every check on what was stored."""
    gold, silver = star.gold(spark, sf_dir), star.silver(spark, sf_dir)
    with sinks.scratch(spark) as base:
        store = refresh.Store(gold, silver, AS_OF, base)
        counts = store.refresh_counting()
        tables = {name: store.table(name) for name in counts}
        report = checks.quality_report(tables, tables.__getitem__, gold, silver, AS_OF, counts=counts)
        with key_filters(spark):
            return sinks.stored(report, sinks.scratch_folder(spark))
