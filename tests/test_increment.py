from __future__ import annotations

from collections import defaultdict
from dataclasses import replace
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.small_tables import CURRENT, gold, sale, silver
from tillroll.operators.distinct_sets import distinct_sets, set_sizes
from tillroll.plans.increment import refresh_daily
from tillroll.plans.refresh import Store

AS_OF = datetime(2001, 8, 1)
CUSTOMERS = [(10, "5", "7", "Customer Card", CURRENT)]
TABLE = "pos_daily_agg_card"


def _day(n):
    return date(2001, 7, n)


def _store(spark, base, sales, as_of=AS_OF, **dims):
    tables = replace(gold(spark, sales, CUSTOMERS), **dims)
    return Store(tables, silver(spark, [(_day(1), 10, 1, "Non-Ecomm Sale")], [(10, "5", CURRENT)]), as_of, base)


def _files(store):
    found = defaultdict(set)
    for path in Path(store.path(TABLE)).glob("fiscal_date=*/*.parquet"):
        found[path.parent.name[-10:]].add(path.name)
    return dict(found)


def _rows(store):
    return sorted(tuple(row) for row in store.table(TABLE).drop("dl_load_dt", "dl_update_dt").collect())


def test_only_changed_days_are_written_again(spark, tmp_path):
    first = _store(spark, f"{tmp_path}/t", [sale(_day(n), txn=n) for n in range(1, 7)])
    assert refresh_daily(first) is None
    before = _files(first)
    # Changed, without rows left in the table (another banner), gone, new; the rest is as it was.
    now = [sale(_day(1), txn=1, units=5), sale(_day(2), txn=2, store=2), *[sale(_day(n), txn=n) for n in (4, 5, 6, 9)]]
    second = _store(spark, f"{tmp_path}/t", now, AS_OF + timedelta(hours=1))
    assert refresh_daily(second) == [_day(1), _day(2), _day(3), _day(9)]
    after = _files(second)
    assert sorted(after) == ["2001-07-01", "2001-07-04", "2001-07-05", "2001-07-06", "2001-07-09"]
    assert {d: after[d] for d in ("2001-07-04", "2001-07-05", "2001-07-06")} == {d: before[d] for d in ("2001-07-04", "2001-07-05", "2001-07-06")}
    assert after["2001-07-01"].isdisjoint(before["2001-07-01"])
    whole = _store(spark, f"{tmp_path}/whole", now)
    whole.refresh([TABLE])
    assert _rows(second) == _rows(whole)
    assert refresh_daily(second) == [] and _files(second) == after


def test_a_repeated_or_missing_value_is_a_change(spark, tmp_path):
    base = f"{tmp_path}/t"
    refresh_daily(_store(spark, base, [sale(_day(1)), sale(_day(2), scan=None)]))
    assert refresh_daily(_store(spark, base, [sale(_day(1)), sale(_day(1)), sale(_day(2), scan="0.00")])) == [_day(1), _day(2)]


def test_a_changed_dimension_rebuilds_all_days(spark, tmp_path):
    sales = [sale(_day(n), txn=n, item=n) for n in (1, 2)]
    refresh_daily(_store(spark, f"{tmp_path}/t", sales))
    items = spark.createDataFrame([(1, "Y"), (2, "Y")], "item_hk bigint, current_financial_sale_flag string")
    changed = _store(spark, f"{tmp_path}/t", sales, item_dim=items)
    assert refresh_daily(changed) is None
    assert len(_rows(changed)) == 2


def test_days_may_be_named_and_old_ones_leave(spark, tmp_path):
    store = _store(spark, f"{tmp_path}/t", [sale(_day(1)), sale(_day(2))])
    refresh_daily(store)
    later = _store(spark, f"{tmp_path}/t", [sale(_day(1), units=3), sale(_day(2), units=3)])
    assert refresh_daily(later, [_day(2)]) == [_day(2)]
    assert [row[-2] for row in _rows(later)] != [3, 3] and 3 in _rows(later)[1]
    years_on = _store(spark, f"{tmp_path}/t", [sale(_day(1)), sale(_day(2)), sale(date(2007, 7, 1))], datetime(2007, 8, 1))
    assert refresh_daily(years_on) == [_day(1), _day(2), date(2007, 7, 1)]
    assert {row[0] for row in _rows(years_on)} == {date(2007, 7, 1)}


def test_tables_in_versions_are_not_changed_in_place(spark, tmp_path):
    store = replace(_store(spark, f"{tmp_path}/t", [sale(_day(1))]), databases={TABLE: "sales"})
    with pytest.raises(ValueError, match="versions"):
        refresh_daily(store)


def test_merged_sets_count_as_a_recount(spark):
    rows = spark.range(3000).select(
        (F.col("id") % 7).alias("card"), (F.col("id") % 3).alias("home"), F.when(F.col("id") % 7 != 6, F.col("id") * F.col("id") % 911 - 300).alias("txn")
    )
    sets = distinct_sets(rows, ["card", "home"], "txn")
    for keys in (["card"], ["home"], ["card", "home"], []):
        recount = rows.groupBy(*keys).agg(F.count_distinct("txn").alias("n"))
        assert sorted(set_sizes(sets, keys, "n").collect()) == sorted(recount.collect())
    assert set_sizes(distinct_sets(rows, ["card"], "txn"), ["card"], "n").where("card = 6").first().n == 0
