"""Data-quality checks of the seven tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from tillroll.domain import (
    ANONYMOUS_CARD,
    BANNER_GROUPS,
    CARD_TYPE_ALIASES,
    HOUSEHOLD_TYPES,
    MIXED_HOUSEHOLD,
    SOF_BANNERS,
    TABLE_KEYS,
    UNKNOWN_CARD_TYPE,
    Settings,
    flag_columns,
    series_names,
)
from tillroll.functions.calendar import WeeklyBounds
from tillroll.functions.retail import recode
from tillroll.operators import quality
from tillroll.operators.fingerprints import row_differences
from tillroll.operators.versions import latest_version
from tillroll.plans.daily_sales import daily_facts
from tillroll.sources.tables import GoldTables, SilverTables

# Names under which the checks appear in the report.
REPORT_NAMES = {
    "pos_daily_agg_card": "pos_daily_agg_card",
    "pos_daily_agg_hhn": "pos_daily_agg_hhn",
    "card_transactions": "card_transactions",
    "household_transactions": "household_transactions",
    "card_shop_dates": "Gold_Card_Shop_Dates",
    "household_shop_dates": "Gold_Household_Shop_Dates",
    "household_type": "Gold_Household_Type",
}
COLUMN_CHECK = "Column Def Check"
DUPLICATE_CHECK = "Data duplication Check"
SHOP_DATES_DUPLICATE_CHECK = "Duplicate Records Check"
SCAN_NULL_CHECK = "Scan Column Null Check"
FLAG_NULL_CHECK = "Columns Null Check"
FLAG_VALUE_CHECK = "Flag values Check"
CARD_COUNT_CHECK = "card numbers count Check"
HOUSEHOLD_COUNT_CHECK = "household count Check"
HOUSEHOLD_COVERAGE_CHECK = "HHN Count Check"
HOUSEHOLD_TYPE_CHECK = "Household Type Check"
CARD_DATES_COVERAGE_CHECK = "Verifying that card_shop_dates table includes all card numbers from client table"
HOUSEHOLD_DATES_COVERAGE_CHECK = (
    "Verifying that household_shop_dates table includes all household_ids from client table"
)

# Recorded in the report, but no reason to fail a run.
ADVISORY_CHECKS = (HOUSEHOLD_COVERAGE_CHECK,)


# A shop in the last 4 weeks is also one in the last 13.
def flag_implications(groups: Mapping[str, Sequence[str]] = BANNER_GROUPS) -> dict[str, str]:
    return {f"{name}_current_4wk_flag": f"{name}_current_13wk_flag" for name in series_names(groups)}


def sold_to(gold: GoldTables, as_of: datetime, attribute: str, banners: Sequence[str] = SOF_BANNERS) -> DataFrame:
    """Distinct cards (or households) behind the facts of the daily tables.

    Customer versions are made distinct before the dimension is joined, so the join never sees
    individual sales.
    """
    versions = daily_facts(gold, as_of, banners).select("customer_hk").distinct()
    return versions.join(gold.customer_dim, "customer_hk").select(attribute).distinct()


def cards_in(card_daily: DataFrame, customer_dim: DataFrame) -> DataFrame:
    versions = card_daily.select("customer_hk").distinct()
    return versions.join(customer_dim, "customer_hk").select("card_number").distinct()


def households_of_active_cards(card_flags: DataFrame, customer_dim: DataFrame, as_of: datetime) -> DataFrame:
    bounds = WeeklyBounds.of(as_of.date())
    weeks = F.col("week_end_date").between(bounds.household_first_week, bounds.last_day)
    active = card_flags.filter(weeks).select("card_number").distinct()
    latest = latest_version(customer_dim, ["card_number"], tie_breakers=["customer_hk"])
    return active.join(latest, "card_number").select(F.col("current_household_id").alias("hhn")).distinct()


def identified_households(customer_dim: DataFrame) -> DataFrame:
    hhn = F.col("current_household_id")
    return customer_dim.filter((F.col("card_number") != ANONYMOUS_CARD) & (hhn != "0")).select(hhn.alias("hhn"))


def identified_card_numbers(customer: DataFrame) -> DataFrame:
    return customer.filter(F.col("card_number") != ANONYMOUS_CARD).select("card_number")


def household_types_recomputed(customer_dim: DataFrame) -> DataFrame:
    """Household types by grouping instead of windowing, so that the check does not repeat the
    code it checks. A household's set of card types is as small as the list of card types."""
    versions = latest_version(customer_dim, ["card_number", "current_household_id"], tie_breakers=["customer_hk"])
    known = F.col("known")
    single = F.when(known[0] == UNKNOWN_CARD_TYPE, MIXED_HOUSEHOLD).otherwise(recode(known[0], HOUSEHOLD_TYPES))
    types = (
        F.when(F.size(known) > 1, F.array(F.lit(MIXED_HOUSEHOLD)))
        .when((F.size(known) == 1) & F.col("has_missing"), F.array(single, F.lit(None).cast("string")))
        .when(F.size(known) == 1, F.array(single))
        .otherwise(F.array(F.lit(None).cast("string")))
    )
    return (
        versions.select(
            F.col("current_household_id").alias("hhn"),
            recode(F.col("current_card_type"), CARD_TYPE_ALIASES).alias("card_type"),
        )
        .groupBy("hhn")
        .agg(F.collect_set("card_type").alias("known"), F.bool_or(F.col("card_type").isNull()).alias("has_missing"))
        .select("hhn", F.explode(types).alias("hh_type"))
    )


def row_violations(name: str, settings: Settings = Settings()) -> dict[str, Column]:
    """The checks of a table that look at one row at a time: what breaks them."""
    if name.startswith("pos_daily"):
        return {SCAN_NULL_CHECK: quality.any_null(["scan"])}
    if name.endswith("transactions"):
        return {
            FLAG_NULL_CHECK: quality.any_null(flag_columns(settings.banner_groups)),
            FLAG_VALUE_CHECK: quality.broken_implication(flag_implications(settings.banner_groups)),
        }
    return {}


def _repeated(name: str, df: DataFrame) -> DataFrame:
    """What repeats in a table that has one row per key; weekly tables have many weeks of few keys."""
    *keys, last = TABLE_KEYS[name]
    if last == "week_end_date" and df.schema[last].dataType == DateType():
        return quality.repeated_days(df, keys, last)
    return quality.duplicate_keys(df, TABLE_KEYS[name])


def table_checks(
    name: str,
    df: DataFrame,
    stored: Callable[[str], DataFrame],
    gold: GoldTables,
    silver: SilverTables,
    as_of: datetime,
    settings: Settings = Settings(),
    counts: Mapping[str, int] | None = None,
    deviating: DataFrame | None = None,
) -> list[DataFrame]:
    """Verdicts of the checks that belong to one table.

    ``stored`` opens other stored tables that a check compares with. ``counts`` are the violations that
    were counted while the table was written; without them the table is read for the row checks.
    ``deviating`` are partitions whose files hold other columns than the table shows.
    """
    duplicate_check = SHOP_DATES_DUPLICATE_CHECK if name.endswith("shop_dates") else DUPLICATE_CHECK
    columns = quality.column_check(COLUMN_CHECK, df, settings.columns[name])
    if deviating is not None and df.columns == list(settings.columns[name]):
        columns = quality.passed_if_empty(COLUMN_CHECK, deviating)
    verdicts = [
        columns,
        quality.passed_if_empty(duplicate_check, _repeated(name, df)),
    ]
    violations = row_violations(name, settings)
    if counts is not None:
        verdicts += [quality.known(df.sparkSession, check, counts[check] == 0) for check in violations]
    elif violations:
        verdicts.append(quality.row_checks(df, violations))

    def covers(check: str, source: DataFrame, key: str) -> DataFrame:
        return quality.passed_if_empty(check, quality.missing_in_target(source, df, [key]))

    # Equal sets, not only sets of equal size.
    agree = (F.col("only_in_source") == 0) & (F.col("only_in_target") == 0)
    customers = gold.customer_dim
    if name == "pos_daily_agg_card":
        sides = quality.reconcile(sold_to(gold, as_of, "card_number", settings.daily_banners), cards_in(df, customers), ["card_number"])
        verdicts.append(quality.passed_if(CARD_COUNT_CHECK, sides, agree))
    elif name == "pos_daily_agg_hhn":
        source = sold_to(gold, as_of, "current_household_id", settings.daily_banners).withColumnRenamed("current_household_id", "hhn")
        verdicts.append(quality.passed_if(HOUSEHOLD_COUNT_CHECK, quality.reconcile(source, df, ["hhn"]), agree))
    elif name == "household_transactions":
        source = households_of_active_cards(stored("card_transactions"), customers, as_of)
        verdicts.append(covers(HOUSEHOLD_COVERAGE_CHECK, source, "hhn"))
    elif name == "card_shop_dates":
        verdicts.append(covers(CARD_DATES_COVERAGE_CHECK, identified_card_numbers(silver.customer), "card_number"))
    elif name == "household_shop_dates":
        verdicts.append(covers(HOUSEHOLD_DATES_COVERAGE_CHECK, identified_households(customers), "hhn"))
    elif name == "household_type":
        types = household_types_recomputed(customers)
        verdicts.append(quality.passed_if_empty(HOUSEHOLD_TYPE_CHECK, row_differences(types, df, ["hhn", "hh_type"], ["hhn"])))
    return verdicts


def quality_report(
    tables: Mapping[str, DataFrame],
    stored: Callable[[str], DataFrame],
    gold: GoldTables,
    silver: SilverTables,
    as_of: datetime,
    settings: Settings = Settings(),
    counts: Mapping[str, Mapping[str, int]] | None = None,
    deviating: Callable[[str], DataFrame | None] = lambda name: None,
) -> DataFrame:
    """All checks of the given tables as one DataFrame, one row per check. ``counts`` holds, for tables
    that were just written, what was counted on the way; ``deviating`` finds the partitions of the others
    whose files hold other columns."""
    counted = counts or {}
    verdicts = {
        REPORT_NAMES[name]: table_checks(name, df, stored, gold, silver, as_of, settings, counted.get(name), None if name in counted else deviating(name))
        for name, df in tables.items()
    }
    return quality.report(verdicts, as_of)
