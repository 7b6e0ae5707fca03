"""Sunday-to-Saturday calendar, once for Python dates and once for date columns.

Every date bound of the jobs follows from the run date alone, so it is plain arithmetic on the
driver; no job has to look a bound up in a table before it can start.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.domain import ACTIVITY_WINDOWS, HISTORY_MONTHS, SPREAD_WEEKS

_ONE_WEEK = 7
_FIRST_SATURDAY = date(1970, 1, 3)


# --- Python dates -----------------------------------------------------------------------------


def days_since_sunday(day: date) -> int:
    return day.isoweekday() % _ONE_WEEK


def last_saturday(day: date) -> date:
    """The Saturday strictly before ``day``."""
    return day - timedelta(days=days_since_sunday(day) + 1)


def last_sunday(day: date) -> date:
    """The Sunday on or before ``day``."""
    return day - timedelta(days=days_since_sunday(day))


def week_end(day: date) -> date:
    """The Saturday that closes the week of ``day``."""
    return day + timedelta(days=_ONE_WEEK - 1 - days_since_sunday(day))


def first_of_month_back(day: date, months: int = HISTORY_MONTHS) -> date:
    year, month = divmod(day.year * 12 + day.month - 1 - months, 12)
    return date(year, month + 1, 1)


def week_number(day: date) -> int:
    """Weeks since the week that ended on 1970-01-03."""
    return (week_end(day) - _FIRST_SATURDAY).days // _ONE_WEEK


@dataclass(frozen=True)
class DailyBounds:
    """Days covered by the daily sales tables; the history is counted from the run date."""

    first_day: date
    last_day: date

    @classmethod
    def of(cls, run_date: date, months: int = HISTORY_MONTHS) -> DailyBounds:
        return cls(last_sunday(first_of_month_back(run_date, months)), last_saturday(run_date))


@dataclass(frozen=True)
class WeeklyBounds:
    """Weeks covered by the activity tables; the history is counted from the last full week.

    A card row may rest on a sale up to 25 weeks older than its week, and its flags look back
    another 25 weeks, hence the three starting points.
    """

    history_start: date
    household_first_week: date
    card_first_week: date
    fact_first_day: date
    last_day: date

    @classmethod
    def of(cls, run_date: date, months: int = HISTORY_MONTHS) -> WeeklyBounds:
        lookback = timedelta(weeks=SPREAD_WEEKS, days=-1)
        last_day = last_saturday(run_date)
        history_start = first_of_month_back(last_day, months)
        household_week = week_end(history_start)
        card_week = week_end(household_week - lookback)
        return cls(history_start, household_week, card_week, card_week - lookback, last_day)


# --- date columns -----------------------------------------------------------------------------


def last_saturday_of(day: Column) -> Column:
    return F.date_sub(F.next_day(F.date_sub(day, 1), "Sat"), _ONE_WEEK)


def last_sunday_of(day: Column) -> Column:
    return F.date_sub(F.next_day(day, "Sun"), _ONE_WEEK)


def week_end_of(day: Column) -> Column:
    return F.next_day(F.date_sub(day, 1), "Sat")


def first_of_month_back_of(day: Column, months: int = HISTORY_MONTHS) -> Column:
    return F.add_months(F.trunc(day, "MM"), -months)


def week_number_of(day: Column) -> Column:
    days = F.date_diff(week_end_of(day), F.lit(_FIRST_SATURDAY))
    return F.call_function("div", days, F.lit(_ONE_WEEK)).cast("int")


def week_end_of_number(number: Column) -> Column:
    return F.date_add(F.lit(_FIRST_SATURDAY), number * _ONE_WEEK)


def window_dates(week: Column) -> dict[str, Column]:
    """First and last day of each activity window seen from ``week`` (a Saturday)."""
    dates = {}
    for name, (newest, oldest) in ACTIVITY_WINDOWS.items():
        dates[f"{name}_start_dt"] = F.date_sub(week, (oldest + 1) * _ONE_WEEK - 1)
        if newest:
            dates[f"{name}_end_dt"] = F.date_sub(week, newest * _ONE_WEEK)
    dates[f"future_{SPREAD_WEEKS}wk_end_dt"] = F.date_add(week, (SPREAD_WEEKS - 1) * _ONE_WEEK)
    return dates


def daily_bounds_of(run_date: Column, months: int = HISTORY_MONTHS) -> dict[str, Column]:
    return {
        "first_day": last_sunday_of(first_of_month_back_of(run_date, months)),
        "last_day": last_saturday_of(run_date),
    }


def weekly_bounds_of(run_date: Column, months: int = HISTORY_MONTHS) -> dict[str, Column]:
    lookback = SPREAD_WEEKS * _ONE_WEEK - 1
    last_day = last_saturday_of(run_date)
    history_start = first_of_month_back_of(last_day, months)
    household_week = week_end_of(history_start)
    card_week = week_end_of(F.date_sub(household_week, lookback))
    return {
        "history_start": history_start,
        "household_first_week": household_week,
        "card_first_week": card_week,
        "fact_first_day": F.date_sub(card_week, lookback),
    }


def calendar_of(df: DataFrame, column: str) -> DataFrame:
    """One row per day from the first to the last ``column`` of ``df``, with the Saturday that ends its
    week; so no day of ``df`` is missing."""
    ends = df.agg(F.min(column).alias("first"), F.max(column).alias("last")).where(F.col("first").isNotNull())
    days = ends.select(F.explode(F.sequence("first", "last")).alias("date"))
    return days.withColumn("week_end_date", week_end_of(F.col("date")))


def calendar_table(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row per day with the Saturday that ends its week; as long as the date range, never longer."""
    days = spark.range((last - first).days + 1).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("date")
    )
    return days.withColumn("week_end_date", week_end_of(F.col("date")))
