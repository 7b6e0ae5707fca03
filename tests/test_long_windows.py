"""Windows beyond one block of weeks, against looking every week up."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tillroll.functions.calendar import week_end
from tillroll.operators.activity import blocks_for, flags_per_week, long_flags_per_week, merge_long_keys, weekly_bitmaps, with_history, with_long_history

FIRST, LAST = date(1998, 1, 3), date(2001, 7, 28)
WINDOWS = {"month": (0, 3), "year": (0, 51), "before": (52, 103), "far": (97, 160), "one": (64, 64)}


def sold(seed, keys="xyz", n=40):
    rng = random.Random(seed)
    return [(rng.choice(keys), FIRST + timedelta(days=rng.randrange(1300)), rng.random() < 0.5) for _ in range(n)]


def by_look_up(rows, windows):
    longest = max(oldest for _, oldest in windows.values())
    out = set()
    for key in {k for k, _, _ in rows}:
        week = FIRST
        while week <= LAST:
            ago = {(week - week_end(day)).days // 7 for k, day, odd in rows if k == key}
            odd = {(week - week_end(day)).days // 7 for k, day, held in rows if k == key and held}
            if any(0 <= a <= longest for a in ago):
                out.add((key, week, *(int(any(new <= a <= old for a in odd)) for new, old in windows.values())))
            week += timedelta(weeks=1)
    return out


def bitmaps(spark, rows):
    events = spark.createDataFrame(rows, "key string, day date, odd boolean")
    return weekly_bitmaps(events, "key", "day", {"any": F.lit(True), "odd": F.col("odd")})


@pytest.mark.parametrize("seed", [1, 2])
def test_flags_match_a_look_up(spark, seed):
    rows = sold(seed)
    histories = with_long_history(bitmaps(spark, rows), "key", ["any", "odd"], blocks_for(WINDOWS))
    flags = long_flags_per_week(histories, "key", "any", ["odd"], WINDOWS, FIRST, LAST)
    assert flags.columns[2:] == [f"odd_{name}_flag" for name in WINDOWS]
    assert {tuple(r) for r in flags.collect()} == by_look_up(rows, WINDOWS)


def test_short_windows_agree_with_the_single_word(spark):
    windows = {"a": (0, 3), "b": (13, 25), "c": (32, 32)}
    made = bitmaps(spark, sold(3))
    short = flags_per_week(with_history(made, "key", ["any", "odd"]), "key", "any", ["odd"], windows, FIRST, LAST)
    long_ = long_flags_per_week(with_long_history(made, "key", ["any", "odd"], 1), "key", "any", ["odd"], windows, FIRST, LAST)
    assert {tuple(r) for r in short.collect()} == {tuple(r) for r in long_.collect()}


def test_coarser_keys_are_merged_before_rows_exist(spark):
    rows = sold(4)
    back = blocks_for(WINDOWS)
    histories = with_long_history(bitmaps(spark, rows), "key", ["any", "odd"], back).withColumn("group", F.lit("g"))
    merged = long_flags_per_week(merge_long_keys(histories, "group", ["any", "odd"], back), "group", "any", ["odd"], WINDOWS, FIRST, LAST)
    assert {tuple(r) for r in merged.collect()} == by_look_up([("g", *r[1:]) for r in rows], WINDOWS)


def test_one_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        histories = with_long_history(bitmaps(spark, sold(5)), "key", ["any", "odd"], 5)
        plan = histories._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    # One to make the bitmaps of a block, one to carry them on.
    assert plan.count("Exchange hashpartitioning") == 2
