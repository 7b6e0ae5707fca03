"""Domain values shared by all plans. Those gathered in ``Settings`` are defaults that callers may replace."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

# They have to read exactly like this for the results to be right.
SOF_BANNERS = ("SOF", "UF", "PSF")
BLF_BANNERS = ("BLF", "NM", "MFF")
LOCATION_TYPES = ("ST", "CS", "LS")
IN_STORE_SALE = "Non-Ecomm Sale"
ECOMM_SALE = "Ecomm Sale"
ANONYMOUS_CARD = "0"
HISTORY_MONTHS = 31

# Sales channel by the last two characters of the register id.
ECOMM_CHANNEL_BY_REGISTER = {"99": "Delivery", "97": "Pickup"}
IN_STORE_CHANNEL = "In Store"
OTHER_CHANNEL = "Adjustment"

# Household type by card type.
CARD_TYPE_ALIASES = {"VMore Cards": "Customer Card"}
HOUSEHOLD_TYPES = {
    "Community Cards": "Community",
    "Customer Card": "Customer",
    "Manager Cards": "Manager",
    "Training Cards": "Training",
}
UNKNOWN_CARD_TYPE = "Unknown"
MIXED_HOUSEHOLD = "Other"

# Activity windows in weeks ago, first and last week inclusive (0 = the week itself).
ACTIVITY_WINDOWS = {
    "current_4wk": (0, 3),
    "current_13wk": (0, 12),
    "prior_13wk": (13, 25),
}
SPREAD_WEEKS = 26

# Flag series: banner group x channel. Flags spell the channel "ecomm", shop dates spell it "ecom".
BANNER_GROUPS = {"sof": SOF_BANNERS, "blf": BLF_BANNERS}
FLAG_CHANNELS = {"instore": IN_STORE_SALE, "ecomm": ECOMM_SALE}
SHOP_CHANNELS = {"instore": IN_STORE_SALE, "ecom": ECOMM_SALE}

# Shop-date scopes: prefix -> banners; None means every banner.
SHOP_SCOPES: dict[str, tuple[str, ...] | None] = {
    "sof": SOF_BANNERS,
    "buylow": BLF_BANNERS,
    **{f"{banner.lower()}_only": (banner,) for banner in (*SOF_BANNERS, *BLF_BANNERS, "QF")},
    "pfg": None,
}


# The scope of every banner, which the overall dates are taken from: there whatever the other scopes are.
OVERALL_SCOPE = "pfg"


def series_names(groups: Mapping[str, Sequence[str]] = BANNER_GROUPS) -> list[str]:
    return [f"{group}_{channel}" for group in groups for channel in FLAG_CHANNELS]


def flag_columns(groups: Mapping[str, Sequence[str]] = BANNER_GROUPS) -> list[str]:
    return [f"{series}_{window}_flag" for series in series_names(groups) for window in ACTIVITY_WINDOWS]


def all_scopes(scopes: Mapping[str, Sequence[str] | None]) -> dict[str, Sequence[str] | None]:
    return {**scopes, OVERALL_SCOPE: None}


def shop_date_columns(scopes: Mapping[str, Sequence[str] | None] = SHOP_SCOPES) -> list[str]:
    """The scoped dates (40 by default) followed by the two overall dates."""
    scoped = [
        f"{scope}_{channel}_{edge}_shop_date"
        for scope in all_scopes(scopes)
        for channel in SHOP_CHANNELS
        for edge in ("first", "last")
    ]
    return [*scoped, "pfg_overall_first_shop_date", "pfg_overall_last_shop_date"]


_MEASURES = ["transaction_count", "sales", "scan", "units", "items"]


def table_columns(
    groups: Mapping[str, Sequence[str]] = BANNER_GROUPS, scopes: Mapping[str, Sequence[str] | None] = SHOP_SCOPES
) -> dict[str, list[str]]:
    """Ordered output columns of the seven tables."""
    dates, flags = shop_date_columns(scopes), flag_columns(groups)
    return {
        "pos_daily_agg_card": ["fiscal_date", "customer_hk", "location_hk", "channel", *_MEASURES, "dl_load_dt", "dl_update_dt"],
        "pos_daily_agg_hhn": ["fiscal_date", "hhn", "location_hk", "channel", *_MEASURES, "dl_load_dt"],
        "card_shop_dates": ["card_number", *dates, "dl_load_dt"],
        "household_shop_dates": ["hhn", *dates, "dl_load_dt"],
        "card_transactions": ["card_number", "week_end_date", *flags, "dl_load_dt", "dl_update_dt"],
        "household_transactions": ["hhn", "week_end_date", *flags, "dl_load_dt"],
        "household_type": ["hhn", "hh_type", "dl_load_dt"],
    }


TABLE_COLUMNS = table_columns()


@dataclass(frozen=True)
class Settings:
    """What a retailer chooses: banners of the daily tables, banner groups of the flags (they name the
    flag columns), location types that count as shops, scopes of the shop dates (they name the date
    columns; None means every banner)."""

    daily_banners: Sequence[str] = SOF_BANNERS
    banner_groups: Mapping[str, Sequence[str]] = field(default_factory=lambda: BANNER_GROUPS)
    location_types: Sequence[str] = LOCATION_TYPES
    shop_scopes: Mapping[str, Sequence[str] | None] = field(default_factory=lambda: SHOP_SCOPES)

    @property
    def columns(self) -> dict[str, list[str]]:
        return table_columns(self.banner_groups, self.shop_scopes)

# Grain of each table, i.e. the columns that identify a row.
TABLE_KEYS = {
    "pos_daily_agg_card": ["fiscal_date", "customer_hk", "location_hk", "channel"],
    "pos_daily_agg_hhn": ["fiscal_date", "hhn", "location_hk", "channel"],
    "card_shop_dates": ["card_number"],
    "household_shop_dates": ["hhn"],
    "card_transactions": ["card_number", "week_end_date"],
    "household_transactions": ["hhn", "week_end_date"],
    "household_type": ["hhn"],
}

# Column by which a table is laid out in storage, where it is partitioned at all.
TABLE_PARTITIONS = {
    "pos_daily_agg_card": "fiscal_date",
    "card_transactions": "week_end_date",
    "household_transactions": "week_end_date",
}
