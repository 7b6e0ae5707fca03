"""First and last shopping dates per banner scope and channel, by card and by household."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.domain import (
    ANONYMOUS_CARD,
    LOCATION_TYPES,
    OVERALL_SCOPE,
    SHOP_CHANNELS,
    SHOP_SCOPES,
    all_scopes,
    shop_date_columns,
    table_columns,
)
from tillroll.functions.calendar import last_saturday
from tillroll.functions.retail import stamped
from tillroll.operators.extremes import first_last, merge_first_last, overall, pivot_first_last
from tillroll.operators.key_filters import join_few
from tillroll.operators.versions import latest_version
from tillroll.sources.tables import SilverTables

_SUFFIX = "shop_date"


def _scope(banners: Sequence[str] | None) -> Column:
    return F.lit(True) if banners is None else F.col("banner_short_name").isin(*banners)


def current_cards(customer: DataFrame) -> DataFrame:
    """Card and customer id of the latest version of every identified card; one row per card."""
    cards = customer.filter(F.col("card_number") != ANONYMOUS_CARD)
    return latest_version(cards, ["card_number"], tie_breakers=["ldw_customer_id"]).select(
        "card_number", "ldw_customer_id"
    )


def current_items(item: DataFrame) -> DataFrame:
    """Ids of the items whose latest version is financial."""
    items = latest_version(item, ["id"], tie_breakers=["financial_sale_flag"])
    return items.filter(F.col("financial_sale_flag") == "Y").select(F.col("id").alias("item_id"))


def current_stores(location: DataFrame, location_types: Sequence[str] = LOCATION_TYPES) -> DataFrame:
    """Number and banner of the stores whose latest version has one of the types."""
    stores = latest_version(location, ["id"], tie_breakers=["banner_short_name", "location_type"])
    return stores.filter(F.col("location_type").isin(*location_types)).select(
        F.col("id").alias("store_number"), "banner_short_name"
    )


def customer_shop_dates(
    tables: SilverTables,
    last_day: date,
    scopes: Mapping[str, Sequence[str] | None] = SHOP_SCOPES,
    location_types: Sequence[str] = LOCATION_TYPES,
    items: DataFrame | None = None,
    stores: DataFrame | None = None,
) -> DataFrame:
    """Shop dates per customer id, before cards come in.

    The facts are reduced to first and last dates by channel per (customer, banner) on the map side;
    only those few rows per customer go through the wide pivot. ``items`` and ``stores`` are results of
    ``current_items`` and ``current_stores`` that are stored already.
    """
    items = current_items(tables.item) if items is None else items
    stores = current_stores(tables.location, location_types) if stores is None else stores
    sales = tables.retail_sale.filter(
        F.col("ecomm_flag").isin(*SHOP_CHANNELS.values()) & (F.col("fiscal_date").cast("date") <= last_day)
    )
    visits = (
        join_few(sales, stores, "store_number")
        .join(items, "item_id")
        .withColumn("fiscal_date", F.col("fiscal_date").cast("date"))
    )
    channels = {channel: F.col("ecomm_flag") == ecomm_flag for channel, ecomm_flag in SHOP_CHANNELS.items()}
    per_banner = first_last(visits, ["customer_id", "banner_short_name"], "fiscal_date", channels)
    selections = {scope: _scope(banners) for scope, banners in all_scopes(scopes).items()}
    dates = pivot_first_last(per_banner, "customer_id", list(channels), selections, _SUFFIX)
    return overall(dates, f"{OVERALL_SCOPE}_overall", [f"{OVERALL_SCOPE}_{channel}" for channel in channels], _SUFFIX)


def card_shop_dates(
    tables: SilverTables,
    as_of: datetime,
    scopes: Mapping[str, Sequence[str] | None] = SHOP_SCOPES,
    location_types: Sequence[str] = LOCATION_TYPES,
    items: DataFrame | None = None,
    stores: DataFrame | None = None,
) -> DataFrame:
    """One row per identified card, with NULL dates where it never shopped.

    The latest version gives each card exactly one customer id, so joining the finished customer
    rows to the cards needs no further grouping and no second pass to bring back idle cards.
    """
    dates = customer_shop_dates(tables, last_saturday(as_of.date()), scopes, location_types, items, stores)
    cards = current_cards(tables.customer)
    joined = cards.join(dates, cards["ldw_customer_id"] == dates["customer_id"], "left")
    return stamped(joined, as_of, "dl_load_dt").select(*table_columns(scopes=scopes)["card_shop_dates"])


def household_shop_dates(
    card_dates: DataFrame,
    customer_dim: DataFrame,
    as_of: datetime,
    scopes: Mapping[str, Sequence[str] | None] = SHOP_SCOPES,
) -> DataFrame:
    """Shop dates over all cards ever seen in a household; cards that moved count in both."""
    memberships = (
        customer_dim.filter(F.col("card_number") != ANONYMOUS_CARD)
        .select("card_number", F.col("current_household_id").alias("hhn"))
        .distinct()
    )
    joined = card_dates.drop("dl_load_dt", "dl_update_dt").join(memberships, "card_number")
    dates = merge_first_last(joined, "hhn", shop_date_columns(scopes))
    return stamped(dates, as_of, "dl_load_dt").select(*table_columns(scopes=scopes)["household_shop_dates"])
