"""Columns that the files of a stored table hold, against those it shows."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.small_tables import CURRENT, gold, sale, silver
from tillroll import jobs
from tillroll.operators.quality import QualityGateError
from tillroll.plans import checks
from tillroll.plans.refresh import Store
from tillroll.sources import sinks
from tillroll.sources.footers import deviating_layouts, stored_layouts

AS_OF = datetime(2001, 8, 1)
NAME = "pos_daily_agg_card"


@pytest.fixture
def store(spark, tmp_path):
    customers = [(10, "5", "h", None, CURRENT)]
    sales = [sale(date(2001, 7, d), txn=d) for d in range(1, 6)]
    old = silver(spark, [(date(2001, 7, 1), 10, 1, "Non-Ecomm Sale")], [(10, "5", CURRENT)])
    return Store(gold(spark, sales, customers), old, AS_OF, f"{tmp_path}/out")


def _rewrite(store, day, change):
    path = f"{store.path(NAME)}/fiscal_date={day}"
    sinks.full_refresh(change(store.spark.read.parquet(path)), path)


@pytest.mark.parametrize(
    ("change", "found"),
    [
        (lambda df: df.drop("units"), ("units", "", False, "")),
        (lambda df: df.withColumn("more", F.lit(1)), ("", "more", False, "")),
        (lambda df: df.select(*df.columns[::-1]), ("", "", True, "")),
        (lambda df: df.withColumn("units", F.col("units").cast("string")), ("", "", False, "units")),
    ],
)
def test_one_deviating_partition_fails_the_column_check(store, change, found):
    counts = store.refresh_counting([NAME])
    jobs.check(store, [NAME])
    assert store.deviating_files(NAME).count() == 0
    _rewrite(store, date(2001, 7, 3), change)
    rows = store.deviating_files(NAME).collect()
    assert [(r.partition, r.missing, r.extra, r.misplaced, r.retyped) for r in rows] == [("fiscal_date=2001-07-03", *found)]
    # The check stands on the files also where the merged read shows the expected columns.
    verdicts = checks.table_checks(NAME, store.table(NAME), store.table, store.gold, store.silver, AS_OF, counts=counts[NAME], deviating=store.deviating_files(NAME))
    assert verdicts[0].first().test_result == "Fail"
    if not found[3]:
        with pytest.raises(QualityGateError, match=checks.COLUMN_CHECK):
            jobs.check(store, [NAME])


def test_versions_in_the_catalog_are_found(store):
    store = Store(store.gold, store.silver, AS_OF, store.base, databases={NAME: "footers_db"})
    try:
        store.refresh([NAME])
        assert store.deviating_files(NAME).count() == 0
    finally:
        store.spark.sql("DROP DATABASE IF EXISTS footers_db CASCADE")


def test_layouts_count_files_and_the_most_frequent_type_is_the_right_one(spark, tmp_path):
    rows = spark.range(6).selectExpr("id AS a", "id AS b")
    for i, df in enumerate([rows, rows, rows.withColumn("b", F.col("b").cast("int"))]):
        sinks.write_table(df.repartition(2), f"{tmp_path}/t/p={i} x")
    layouts = stored_layouts(spark, f"{tmp_path}/t")
    assert {(r.partition, r.files) for r in layouts.collect()} == {("p=0 x", 2), ("p=1 x", 2), ("p=2 x", 2)}
    found = deviating_layouts(layouts, ["a", "b"]).collect()
    assert [(r.partition, r.retyped) for r in found] == [("p=2 x", "b")]
    sinks.write_table(rows.limit(0), f"{tmp_path}/empty")
    assert deviating_layouts(stored_layouts(spark, f"{tmp_path}/empty"), ["a", "b"]).count() == 0
