"""Household type from the card types of a household."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.domain import CARD_TYPE_ALIASES, TABLE_COLUMNS
from tillroll.functions.retail import household_type as household_type_of
from tillroll.functions.retail import recode, stamped
from tillroll.operators.versions import latest_version


def household_card_types(customer_dim: DataFrame) -> DataFrame:
    """Distinct card types per household, from the latest version of each card in each household."""
    versions = latest_version(
        customer_dim, ["card_number", "current_household_id"], tie_breakers=["customer_hk"]
    )
    return versions.select(
        F.col("current_household_id").alias("hhn"),
        recode(F.col("current_card_type"), CARD_TYPE_ALIASES).alias("card_type"),
    ).distinct()


def with_card_type_count(card_types: DataFrame) -> DataFrame:
    """Known card types per household, on every row. Rows are distinct per household and type by
    now, so a window holds as many rows as there are card types."""
    per_household = F.count("card_type").over(Window.partitionBy("hhn"))
    return card_types.withColumn("card_type_count", per_household)


def household_types(customer_dim: DataFrame) -> DataFrame:
    """Household and type. A household with both missing and known card types keeps a row for each."""
    counted = with_card_type_count(household_card_types(customer_dim))
    return counted.select(
        "hhn", household_type_of(F.col("card_type"), F.col("card_type_count")).alias("hh_type")
    ).distinct()


def household_type(customer_dim: DataFrame, as_of: datetime) -> DataFrame:
    return stamped(household_types(customer_dim), as_of, "dl_load_dt").select(*TABLE_COLUMNS["household_type"])
