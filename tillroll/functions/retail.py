"""Column expressions of the retail domain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll import domain


def sales_channel(ecomm_flag: Column, register_id: Column) -> Column:
    """Channel of a sale; anything that is not clearly in store, pickup or delivery is an adjustment."""
    station = F.right(register_id, F.lit(2))
    cases = F.when(ecomm_flag == domain.IN_STORE_SALE, domain.IN_STORE_CHANNEL)
    for suffix, channel in domain.ECOMM_CHANNEL_BY_REGISTER.items():
        cases = cases.when((ecomm_flag == domain.ECOMM_SALE) & (station == suffix), channel)
    return cases.otherwise(domain.OTHER_CHANNEL)


def recode(value: Column, mapping: Mapping[str, str]) -> Column:
    """Replace the listed values, keep all others."""
    cases = F
    for old, new in mapping.items():
        cases = cases.when(value == old, new)
    return cases.otherwise(value)


def household_type(card_type: Column, card_types_in_household: Column) -> Column:
    mixed = (card_types_in_household > 1) | (card_type == domain.UNKNOWN_CARD_TYPE)
    return F.when(mixed, domain.MIXED_HOUSEHOLD).otherwise(recode(card_type, domain.HOUSEHOLD_TYPES))


def load_stamp(as_of: datetime) -> Column:
    """The run time as a zone-free timestamp literal."""
    return F.to_timestamp_ntz(F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")))


def stamped(df: DataFrame, as_of: datetime, *columns: str) -> DataFrame:
    return df.withColumns({name: load_stamp(as_of) for name in columns})


def cast_timestamps(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("timestamp") for name in columns})
