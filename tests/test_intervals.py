"""Interval joins against all pairs, whatever the lengths, and where one bin holds most rows."""

from __future__ import annotations

import random
import re
from datetime import date, timedelta

import pytest

from tillroll.operators import skew
from tillroll.operators.intervals import interval_join

DAY = date(1969, 11, 20)


def spans(seed, n, longest):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        start = DAY + timedelta(days=rng.randrange(120))
        rows.append((i, start, start + timedelta(days=rng.randrange(-1, longest))))
    return [*rows, (n, None, DAY), (n + 1, DAY, None)]


def tables(spark, left, right):
    return spark.createDataFrame(left, "a long, a_from date, a_to date"), spark.createDataFrame(right, "b long, b_from date, b_to date")


def joined(spark, left, right):
    return interval_join(*tables(spark, left, right), ("a_from", "a_to"), ("b_from", "b_to"))


def all_pairs(left, right):
    whole = [[r for r in rows if r[1] and r[2] and r[1] <= r[2]] for rows in (left, right)]
    return sorted((a[0], b[0]) for a in whole[0] for b in whole[1] if a[1] <= b[2] and b[1] <= a[2])


@pytest.mark.parametrize(("longest_left", "longest_right"), [(1, 1), (1, 90), (90, 1), (12, 300), (4000, 3)])
def test_every_pair_once(spark, longest_left, longest_right):
    left, right = spans(1, 60, longest_left), spans(2, 50, longest_right)
    found = joined(spark, left, right)
    assert found.columns == ["a", "a_from", "a_to", "b", "b_from", "b_to"]
    assert sorted((r.a, r.b) for r in found.select("a", "b").collect()) == all_pairs(left, right)


def test_busy_bins_and_empty_sides(spark, monkeypatch):
    monkeypatch.setattr(skew, "BUSY_SHARE", 4)
    left = [(i, DAY, DAY + timedelta(days=i % 2)) for i in range(40)] + spans(3, 20, 30)
    right = spans(4, 30, 9)
    assert sorted((r.a, r.b) for r in joined(spark, left, right).collect()) == all_pairs(left, right)
    assert joined(spark, left, []).count() == joined(spark, [], right).count() == 0


def test_no_join_without_a_key(spark):
    plan = joined(spark, spans(5, 9, 9), spans(6, 9, 9))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan)


def test_long_intervals_touch_few_bins(spark):
    """A row for each level of the other side and two bins at most, however long an interval is."""
    from pyspark.sql import functions as F

    from tillroll.operators.intervals import _in_bins, _measured

    row = [(1, DAY, DAY + timedelta(days=100_000))]
    measured = _measured(tables(spark, row, row)[0], "a_from", "a_to", "_l").withColumn("_levels", F.array("_l_level"))
    assert _in_bins(measured, "_l", F.col("_levels")).count() <= 2
