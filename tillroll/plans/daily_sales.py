"""Daily sales per card and per household."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.domain import HISTORY_MONTHS, SOF_BANNERS, TABLE_COLUMNS
from tillroll.functions.calendar import DailyBounds
from tillroll.functions.retail import sales_channel, stamped
from tillroll.operators.key_filters import join_few
from tillroll.operators.skew import join_spread
from tillroll.sources.tables import GoldTables


def financial_items(item_dim: DataFrame) -> DataFrame:
    return item_dim.filter(F.col("current_financial_sale_flag") == "Y").select("item_hk")


def daily_facts(
    tables: GoldTables,
    as_of: datetime,
    banners: Sequence[str] = SOF_BANNERS,
    months: int = HISTORY_MONTHS,
) -> DataFrame:
    """Facts of financial items sold under ``banners`` on the days the daily tables cover."""
    bounds = DailyBounds.of(as_of.date(), months)
    stores = tables.location_dim.filter(F.col("current_banner_short_name").isin(*banners)).select("location_hk")
    facts = tables.retail_sale_fact.filter(F.col("fiscal_date").between(bounds.first_day, bounds.last_day))
    return join_few(facts, stores, "location_hk").join(financial_items(tables.item_dim), "item_hk")


def pos_daily_agg_card(
    tables: GoldTables,
    as_of: datetime,
    banners: Sequence[str] = SOF_BANNERS,
    months: int = HISTORY_MONTHS,
) -> DataFrame:
    """Sales per day, customer, location and channel; the anonymous card counts like any other.

    The distinct count makes Spark shuffle on the whole key plus the transaction number first, so
    one very busy customer or store is spread over all tasks and arrives there as one row per
    transaction.
    """
    registers = tables.register_dim.select("register_hk", F.col("id").alias("register_id"))
    channel = sales_channel(F.col("ecomm_flag"), F.col("register_id")).alias("channel")
    daily = (
        daily_facts(tables, as_of, banners, months)
        .join(registers, "register_hk", "left")
        .groupBy("fiscal_date", "customer_hk", "location_hk", channel)
        .agg(
            F.count_distinct("transaction_number").alias("transaction_count"),
            F.sum("merch_sales").alias("sales"),
            F.sum(F.coalesce("merch_scan_margin", F.lit(0))).alias("scan"),
            F.sum("unit_count").alias("units"),
            F.sum("item_count").alias("items"),
        )
    )
    return stamped(daily, as_of, "dl_load_dt", "dl_update_dt").select(*TABLE_COLUMNS["pos_daily_agg_card"])


def pos_daily_agg_hhn(
    card_daily: DataFrame,
    customer_dim: DataFrame,
    as_of: datetime,
    months: int = HISTORY_MONTHS,
    busy: DataFrame | None = None,
) -> DataFrame:
    """Card-level rows summed per household. Transaction counts are added up, not counted afresh:
    a transaction that touches two channels or two card versions counts in each.

    A busy version (the anonymous card has rows for every day, store and channel) is spread over
    many tasks where its rows meet their household. Where ``card_daily`` is not stored, counting it would
    work it out again: ``busy`` are the busy versions by another count, say of the sales.
    """
    bounds = DailyBounds.of(as_of.date(), months)
    households = customer_dim.select("customer_hk", F.col("current_household_id").alias("hhn"))
    measures = ["transaction_count", "sales", "scan", "units", "items"]
    rows = card_daily.filter(F.col("fiscal_date").between(bounds.first_day, bounds.last_day))
    daily = (
        join_spread(rows, households, "customer_hk", ["fiscal_date", "location_hk", "channel"], busy)
        .groupBy("fiscal_date", "hhn", "location_hk", "channel")
        .agg(*[F.sum(name).alias(name) for name in measures])
    )
    return stamped(daily, as_of, "dl_load_dt").select(*TABLE_COLUMNS["pos_daily_agg_hhn"])
