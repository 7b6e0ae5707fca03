"""Rolling weekly activity flags by card and by household."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.domain import (
    ACTIVITY_WINDOWS,
    ANONYMOUS_CARD,
    BANNER_GROUPS,
    FLAG_CHANNELS,
    HISTORY_MONTHS,
    LOCATION_TYPES,
    flag_columns,
    series_names,
    table_columns,
)
from tillroll.functions.calendar import WeeklyBounds
from tillroll.functions.retail import stamped
from tillroll.operators.activity import (
    blocks_for,
    flags_per_week,
    long_flags_per_week,
    merge_keys,
    merge_long_keys,
    pack_flags,
    packed_flags_per_week,
    unpack_flags,
    unpack_words,
    weekly_bitmaps,
    with_history,
    with_long_history,
)
from tillroll.operators.key_filters import join_few
from tillroll.operators.versions import latest_version
from tillroll.plans.daily_sales import financial_items
from tillroll.sources.tables import GoldTables

# Weeks in which any qualifying sale was made, whatever its channel: they decide which rows exist.
_PRESENCE = "visits"


def identified_cards(customer_dim: DataFrame) -> DataFrame:
    return customer_dim.filter(F.col("card_number") != ANONYMOUS_CARD)


def household_of_card(customer_dim: DataFrame) -> DataFrame:
    """Household named by the latest version of each identified card."""
    latest = latest_version(identified_cards(customer_dim), ["card_number"], tie_breakers=["customer_hk"])
    return latest.select("card_number", F.col("current_household_id").alias("hhn"))


def weekly_facts(
    tables: GoldTables,
    bounds: WeeklyBounds,
    groups: Mapping[str, Sequence[str]] = BANNER_GROUPS,
    location_types: Sequence[str] = LOCATION_TYPES,
) -> DataFrame:
    """Facts of financial items sold in stores of the banner groups, with the banner at hand."""
    banners = [banner for members in groups.values() for banner in members]
    stores = tables.location_dim.filter(
        F.col("current_banner_short_name").isin(*banners) & F.col("location_type").isin(*location_types)
    ).select("location_hk", "current_banner_short_name")
    facts = tables.retail_sale_fact.filter(F.col("fiscal_date").between(bounds.fact_first_day, bounds.last_day)).select(
        "fiscal_date", "location_hk", "item_hk", "customer_hk", "ecomm_flag"
    )
    return join_few(facts, stores, "location_hk").join(financial_items(tables.item_dim), "item_hk")


def _series(bounds: WeeklyBounds, groups: Mapping[str, Sequence[str]]) -> dict[str, Column]:
    # Sales before the first row week set flags on later rows but create no row themselves.
    first_row_day = F.date_sub(F.lit(bounds.card_first_week), 6)
    series = {_PRESENCE: F.col("fiscal_date") >= first_row_day}
    for group, banners in groups.items():
        for channel, ecomm_flag in FLAG_CHANNELS.items():
            sold = F.col("current_banner_short_name").isin(*banners) & (F.col("ecomm_flag") == ecomm_flag)
            series[f"{group}_{channel}"] = sold
    return series


def card_histories(
    tables: GoldTables,
    bounds: WeeklyBounds,
    groups: Mapping[str, Sequence[str]] = BANNER_GROUPS,
    location_types: Sequence[str] = LOCATION_TYPES,
) -> DataFrame:
    """Activity bitmaps with history per identified card and 32-week block.

    Facts are reduced per customer version before customers are joined: the join sees a handful of
    rows per version, and none of a busy version's (or the anonymous card's) individual sales.
    """
    series = _series(bounds, groups)
    facts = weekly_facts(tables, bounds, groups, location_types)
    by_version = weekly_bitmaps(facts, "customer_hk", "fiscal_date", series)
    cards = identified_cards(tables.customer_dim).select("customer_hk", "card_number")
    return with_history(by_version.join(cards, "customer_hk"), "card_number", list(series))


def card_transactions(
    tables: GoldTables,
    as_of: datetime,
    months: int = HISTORY_MONTHS,
    groups: Mapping[str, Sequence[str]] = BANNER_GROUPS,
    location_types: Sequence[str] = LOCATION_TYPES,
) -> DataFrame:
    """0/1 flags (six for each banner group) per card and week, for every week up to 25 weeks after a
    shopping week."""
    bounds = WeeklyBounds.of(as_of.date(), months)
    return card_flags(card_histories(tables, bounds, groups, location_types), as_of, months, groups)


def card_flags(
    histories: DataFrame,
    as_of: datetime,
    months: int = HISTORY_MONTHS,
    groups: Mapping[str, Sequence[str]] = BANNER_GROUPS,
) -> DataFrame:
    """The card table from bitmaps that ``card_histories`` made for the same run date, months and groups."""
    flags = flags_per_week(histories, *_card_weeks(as_of, months, groups))
    return stamped(flags, as_of, "dl_load_dt", "dl_update_dt").select(*table_columns(groups)["card_transactions"])


def packed_card_flags(
    histories: DataFrame,
    as_of: datetime,
    months: int = HISTORY_MONTHS,
    groups: Mapping[str, Sequence[str]] = BANNER_GROUPS,
) -> DataFrame:
    """The rows of ``card_flags`` before ``unpacked``: a third as wide, for the way to the writer."""
    return packed_flags_per_week(histories, *_card_weeks(as_of, months, groups))


def unpacked(
    packed: DataFrame, table: str, as_of: datetime, groups: Mapping[str, Sequence[str]] = BANNER_GROUPS
) -> DataFrame:
    """The card or household table from its packed rows."""
    columns = table_columns(groups)[table]
    flags = packed.select(columns[0], columns[1], *unpack_words(flag_columns(groups)))
    return stamped(flags, as_of, *[name for name in columns if name not in flags.columns]).select(*columns)


def _card_weeks(as_of: datetime, months: int, groups: Mapping[str, Sequence[str]]) -> tuple:
    bounds = WeeklyBounds.of(as_of.date(), months)
    return "card_number", _PRESENCE, series_names(groups), ACTIVITY_WINDOWS, bounds.card_first_week, bounds.last_day


def household_transactions(
    card_flags: DataFrame,
    customer_dim: DataFrame,
    as_of: datetime,
    months: int = HISTORY_MONTHS,
    groups: Mapping[str, Sequence[str]] = BANNER_GROUPS,
) -> DataFrame:
    """Household flags from the stored card table: a flag is set when any card of the household has it.

    The flags travel through both shuffles as one integer and are merged by ``bit_or``.
    """
    bounds = WeeklyBounds.of(as_of.date(), months)
    merged = (
        card_flags.filter(F.col("week_end_date").between(bounds.household_first_week, bounds.last_day))
        .select("card_number", "week_end_date", pack_flags(flag_columns(groups)).alias("flags"))
        .join(household_of_card(customer_dim), "card_number")
        .groupBy("hhn", "week_end_date")
        .agg(F.bit_or("flags").alias("flags"))
    )
    flags = merged.select("hhn", "week_end_date", *unpack_flags("flags", flag_columns(groups)))
    return stamped(flags, as_of, "dl_load_dt").select(*table_columns(groups)["household_transactions"])


def household_transactions_from_sales(
    tables: GoldTables,
    as_of: datetime,
    months: int = HISTORY_MONTHS,
    groups: Mapping[str, Sequence[str]] = BANNER_GROUPS,
    location_types: Sequence[str] = LOCATION_TYPES,
) -> DataFrame:
    """The same table straight from the facts."""
    bounds = WeeklyBounds.of(as_of.date(), months)
    histories = card_histories(tables, bounds, groups, location_types)
    return household_flags(histories, tables.customer_dim, as_of, months, groups)


def household_flags(
    card_bitmaps: DataFrame,
    customer_dim: DataFrame,
    as_of: datetime,
    months: int = HISTORY_MONTHS,
    groups: Mapping[str, Sequence[str]] = BANNER_GROUPS,
) -> DataFrame:
    """The household table from the bitmaps of ``card_histories``, merged before any weekly row exists.

    This is exact because the household weeks start 25 weeks after the card weeks: whatever a row
    looks back on also made a card row.
    """
    flags = flags_per_week(*_household_weeks(card_bitmaps, customer_dim, as_of, months, groups))
    return stamped(flags, as_of, "dl_load_dt").select(*table_columns(groups)["household_transactions"])


def packed_household_flags(
    card_bitmaps: DataFrame,
    customer_dim: DataFrame,
    as_of: datetime,
    months: int = HISTORY_MONTHS,
    groups: Mapping[str, Sequence[str]] = BANNER_GROUPS,
) -> DataFrame:
    """The rows of ``household_flags`` before ``unpacked``."""
    return packed_flags_per_week(*_household_weeks(card_bitmaps, customer_dim, as_of, months, groups))


def _household_weeks(
    card_bitmaps: DataFrame, customer_dim: DataFrame, as_of: datetime, months: int, groups: Mapping[str, Sequence[str]]
) -> tuple:
    bounds = WeeklyBounds.of(as_of.date(), months)
    histories = card_bitmaps.join(household_of_card(customer_dim), "card_number")
    merged = merge_keys(histories, "hhn", [_PRESENCE, *series_names(groups)])
    return merged, "hhn", _PRESENCE, series_names(groups), ACTIVITY_WINDOWS, bounds.household_first_week, bounds.last_day


def activity_in_windows(
    tables: GoldTables,
    bounds: WeeklyBounds,
    windows: Mapping[str, tuple[int, int]],
    by_household: bool = False,
    groups: Mapping[str, Sequence[str]] = BANNER_GROUPS,
    location_types: Sequence[str] = LOCATION_TYPES,
) -> DataFrame:
    """0/1 flags per card (or household) and week over windows of any length, named by the caller.

    ``windows`` maps a name to its newest and oldest week ago. There is a row for each week from
    ``bounds.card_first_week`` to ``bounds.last_day`` with a sale within the longest window;
    ``bounds.fact_first_day`` is the first day whose sales count.
    """
    series = series_names(groups)
    # Every sale makes rows here, so the presence has no first day of its own.
    held = _series(bounds, groups) | {_PRESENCE: F.lit(True)}
    facts = weekly_facts(tables, bounds, groups, location_types)
    by_version = weekly_bitmaps(facts, "customer_hk", "fiscal_date", held)
    cards = identified_cards(tables.customer_dim).select("customer_hk", "card_number")
    back = blocks_for(windows)
    histories = with_long_history(by_version.join(cards, "customer_hk"), "card_number", list(held), back)
    key = "card_number"
    if by_household:
        key = "hhn"
        histories = histories.join(household_of_card(tables.customer_dim), "card_number")
        histories = merge_long_keys(histories, key, list(held), back)
    return long_flags_per_week(histories, key, _PRESENCE, series, windows, bounds.card_first_week, bounds.last_day)
