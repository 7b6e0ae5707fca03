"""Joins between dates and date ranges, planned as equi-joins or as plain expansion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def flag_in_window(
    spine: DataFrame,
    events: DataFrame,
    key: str,
    event_date: str,
    window_start: str,
    window_end: str,
    flag: str,
    condition: Column | None = None,
) -> DataFrame:
    """Spine rows with at least one event of the same key inside their closed date window.

    General form for any window. Events shrink to one row per key and day before the join, so the
    busiest key brings no more rows than the calendar has days. A spine row is tested, never
    multiplied (left semi).
    """
    hits = events if condition is None else events.filter(condition)
    days = hits.select(F.col(key).alias("_key"), F.col(event_date).alias("_day")).distinct()
    inside = F.col("_day").between(F.col(window_start), F.col(window_end))
    return spine.join(days, (F.col(key) == F.col("_key")) & inside, "left_semi").withColumn(flag, F.lit(1))


def spread_weeks(weeks: DataFrame, key: str, week: str, n_weeks: int, last_week: Column) -> DataFrame:
    """Each (key, week) together with the following weeks, ``n_weeks`` in all, cut at ``last_week``.

    Every week is filled up to the key's next own week only, so each result row is produced exactly
    once: there is no range join and nothing to de-duplicate after the expansion.
    """
    own = weeks.select(key, week).distinct()
    following = F.lead(week).over(Window.partitionBy(key).orderBy(week))
    reach = F.least(F.date_add(F.col(week), 7 * (n_weeks - 1)), F.date_sub(following, 7), last_week)
    filled = F.sequence(F.col(week), F.col("_reach"), F.expr("interval 7 days"))
    return (
        own.filter(F.col(week) <= last_week)
        .withColumn("_reach", reach)
        .select(key, F.explode(filled).alias(week))
    )
