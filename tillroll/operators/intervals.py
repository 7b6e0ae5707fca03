"""Joins of overlapping date intervals that share no key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators.skew import join_spread

_FIRST, _LAST, _LEVEL, _BIN = "_first", "_last", "_level", "_bin"


def _shifted(day: Column, level: Column) -> Column:
    return F.call_function("shiftright", day, level)


def _measured(df: DataFrame, first: str, last: str, side: str) -> DataFrame:
    """Intervals with a day at least, as day numbers, and the level: bins of 2**level days hold the
    interval in one bin or two neighbouring ones."""
    start, end = F.unix_date(F.col(first).cast("date")), F.unix_date(F.col(last).cast("date"))
    days = F.col(side + _LAST) - F.col(side + _FIRST)
    level = F.when(days < 1, 0).otherwise(F.length(F.bin(days.cast("bigint"))))
    return (
        df.withColumns({side + _FIRST: start, side + _LAST: end})
        .where(F.col(side + _FIRST) <= F.col(side + _LAST))
        .withColumn(side + _LEVEL, level)
    )


def _levels(df: DataFrame, side: str) -> Column:
    """The levels that occur, 32 at most, as a scalar subquery."""
    return df.agg(F.array_sort(F.collect_set(side + _LEVEL))).scalar()


def _in_bins(df: DataFrame, side: str, levels: Column) -> DataFrame:
    """A row for each bin of each of the levels that the interval touches."""
    level = F.col("_at")
    bins = F.sequence(_shifted(F.col(side + _FIRST), level), _shifted(F.col(side + _LAST), level))
    return (
        df.withColumn("_at", F.explode(levels))
        .withColumn("_number", F.explode(bins))
        .withColumn(_BIN, F.struct(F.col("_at").alias("level"), F.col("_number").alias("number")))
        .drop("_at", "_number", "_levels")
    )


def interval_join(
    left: DataFrame, right: DataFrame, left_span: Sequence[str], right_span: Sequence[str]
) -> DataFrame:
    """Pairs of rows whose closed intervals (first day, last day) have a day in common, each pair once.

    The time line is cut into bins of 1, 2, 4, ... days. Two intervals meet where the bins are as wide
    as the longer of them asks for: there each touches two bins at most, so a long interval is not
    spread over many bins, and every pair that meets has one interval about as long as its bin. Only
    the levels of the other side are used, so intervals of a few lengths make few rows. A pair may meet
    in two bins; it counts in the one that holds the later start. Rows of a busy bin on the left are
    spread over parts (``join_spread``).

    An interval with a missing end, or one that ends before it starts, meets nothing. Column names of the two
    sides must differ.
    """
    rows, others = _measured(left, *left_span, "_l"), _measured(right, *right_span, "_r")
    own_left, own_right = F.col("_l" + _LEVEL), F.col("_r" + _LEVEL)
    left_levels, right_levels = _levels(rows, "_l"), _levels(others, "_r")
    rows, others = rows.withColumn("_levels", right_levels), others.withColumn("_levels", left_levels)
    # At the level of the left interval, with right ones that are no longer; then the other way round.
    meetings = [
        (F.array(own_left), F.filter("_levels", lambda m: m >= own_right)),
        (F.filter("_levels", lambda m: m > own_left), F.array(own_right)),
    ]
    later = F.greatest("_l" + _FIRST, "_r" + _FIRST)
    overlap = (F.col("_l" + _FIRST) <= F.col("_r" + _LAST)) & (F.col("_r" + _FIRST) <= F.col("_l" + _LAST))
    counted_here = F.col(f"{_BIN}.number") == _shifted(later, F.col(f"{_BIN}.level"))
    pairs = [
        join_spread(_in_bins(rows, "_l", at_left), _in_bins(others, "_r", at_right), _BIN, left.columns)
        .where(overlap & counted_here)
        .select(*left.columns, *right.columns)
        for at_left, at_right in meetings
    ]
    return pairs[0].unionByName(pairs[1])
