from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.test_hot_keys import _shuffled
from tillroll.domain import Settings, flag_columns
from tillroll.operators import quality
from tillroll.plans import checks, refresh
from tillroll.sources import sinks, star

AS_OF = datetime(2001, 8, 1)
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark):
    gold, silver = star.gold(spark, SF), star.silver(spark, SF)
    return gold, silver, refresh.Store(gold, silver, AS_OF, sinks.scratch_folder(spark), layout={}).refresh()


def _results(report):
    return {(r.table_name, r.test_case_name): r.test_result for r in report.collect()}


def test_report_passes_except_for_households_with_two_types(stored):
    gold, silver, tables = stored
    report = checks.quality_report(tables, tables.get, gold, silver, AS_OF)
    results = _results(report)
    assert report.columns == quality.RESULT_COLUMNS
    assert len(results) == 26
    assert [key for key, result in results.items() if result != "Pass"] == [
        ("Gold_Household_Type", checks.DUPLICATE_CHECK)
    ]
    with pytest.raises(quality.QualityGateError, match="Gold_Household_Type: Data duplication Check"):
        quality.enforce(report)
    quality.enforce(report, advisory=[checks.DUPLICATE_CHECK])


def test_broken_tables_are_reported(stored):
    gold, silver, tables = stored
    flags = tables["card_transactions"]
    first_flag = flag_columns()[0]
    some = F.col("card_number") == "7"
    broken = {
        "card_transactions": flags.unionByName(flags.filter(some)).withColumn(
            first_flag, F.when(some, F.lit(None)).otherwise(1)
        ),
        "pos_daily_agg_card": tables["pos_daily_agg_card"].filter("customer_hk > 20").withColumn(
            "scan", F.when(F.col("location_hk") > 0, F.col("scan"))
        ),
        "pos_daily_agg_hhn": tables["pos_daily_agg_hhn"].drop("dl_load_dt").filter("hhn > '3'"),
        "card_shop_dates": tables["card_shop_dates"].filter("card_number <> '7'"),
        "household_shop_dates": tables["household_shop_dates"].filter("hhn > '3'"),
        "household_transactions": tables["household_transactions"].filter("hhn > '3'"),
        "household_type": tables["household_type"].withColumn("hh_type", F.lit("Other")).distinct(),
    }
    results = _results(checks.quality_report(broken, broken.get, gold, silver, AS_OF))
    failed = {key for key, result in results.items() if result == "Fail"}
    assert {
        ("card_transactions", checks.DUPLICATE_CHECK),
        ("card_transactions", checks.FLAG_NULL_CHECK),
        ("card_transactions", checks.FLAG_VALUE_CHECK),
        ("pos_daily_agg_card", checks.CARD_COUNT_CHECK),
        ("pos_daily_agg_card", checks.SCAN_NULL_CHECK),
        ("pos_daily_agg_hhn", checks.COLUMN_CHECK),
        ("pos_daily_agg_hhn", checks.HOUSEHOLD_COUNT_CHECK),
        ("Gold_Card_Shop_Dates", checks.CARD_DATES_COVERAGE_CHECK),
        ("Gold_Household_Shop_Dates", checks.HOUSEHOLD_DATES_COVERAGE_CHECK),
        ("household_transactions", checks.HOUSEHOLD_COVERAGE_CHECK),
        ("Gold_Household_Type", checks.HOUSEHOLD_TYPE_CHECK),
    } <= failed


def test_sets_of_equal_size_that_differ_fail(stored):
    gold, silver, tables = stored
    daily = tables["pos_daily_agg_hhn"]
    some = daily.first().hhn
    swapped = {"pos_daily_agg_hhn": daily.withColumn("hhn", F.when(F.col("hhn") == some, "another").otherwise(F.col("hhn")))}
    results = _results(checks.quality_report(swapped, swapped.get, gold, silver, AS_OF))
    assert results["pos_daily_agg_hhn", checks.HOUSEHOLD_COUNT_CHECK] == "Fail"


def test_sides_treat_nulls_as_equal_and_count_rows_once(spark):
    left = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "k string")
    right = spark.createDataFrame([(None,), ("b",), ("c",), ("c",)], "k string")
    assert [r.k for r in quality.missing_in_target(left, right, ["k"]).collect()] == ["a"]
    assert quality.reconcile(left, right, ["k"]).first().asDict() == {
        "source_rows": 3, "target_rows": 3, "only_in_source": 1, "only_in_target": 1,
    }


def test_null_counts_and_duplicates(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("x", None)], "a string, b int")
    assert {r.column_name: r.null_count for r in quality.null_counts(df, ["a", "b"]).collect()} == {"a": 2, "b": 1}
    assert [(r.a, r.b, r.cnt) for r in quality.duplicate_keys(df, ["a", "b"]).collect()] == [(None, 1, 2)]


def test_row_checks_share_one_pass(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "a int, b int")
    verdicts = quality.row_checks(df, {"a null": quality.any_null(["a"]), "b null": quality.any_null(["a", "b"])})
    assert {r.test_case_name: r.test_result for r in verdicts.collect()} == {"a null": "Pass", "b null": "Fail"}


def test_implication_counts(spark):
    df = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (0, 0, 1), (1, None, 1)], "p int, c int, other int")
    rows = quality.implication_counts(df, {"p": "c", "other": "p"}).collect()
    assert {r.premise: (r.premise_rows, r.broken_rows) for r in rows} == {"p": (3, 1), "other": (2, 1)}


def test_counts_are_taken_while_rows_are_written(spark, tmp_path):
    rows = spark.range(1000).withColumn("x", F.when(F.col("id") % 10 > 0, F.col("id")))
    watched, observation = quality.counting(rows.repartition(5), {"x is missing": quality.any_null(["x"]), "never": F.lit(False)})
    watched.write.parquet(f"{tmp_path}/rows")
    assert observation.get == {"rows": 1000, "x is missing": 100, "never": 0}


def test_counted_row_checks_read_no_table(spark, tmp_path):
    settings = Settings()
    flags = spark.range(3).select(*[F.lit(0).alias(name) for name in settings.columns["card_transactions"]])
    flags.write.parquet(f"{tmp_path}/flags")
    stored = spark.read.parquet(f"{tmp_path}/flags")
    counts = {"rows": 3, checks.FLAG_NULL_CHECK: 0, checks.FLAG_VALUE_CHECK: 2}
    verdicts = checks.table_checks("card_transactions", stored, {}.get, star.gold(spark, SF), star.silver(spark, SF), AS_OF, settings, counts)
    results = {r.test_case_name: r.test_result for v in verdicts for r in v.collect()}
    assert results[checks.FLAG_NULL_CHECK] == "Pass" and results[checks.FLAG_VALUE_CHECK] == "Fail"
    reading = [v for v in verdicts if "parquet" in v._jdf.queryExecution().optimizedPlan().toString()]
    assert [v.collect()[0].test_case_name for v in reading] == [checks.DUPLICATE_CHECK]


def test_repeated_days_are_found_wherever_keys_and_days_repeat(spark):
    days = [date(1969, 12, 27), date(2001, 7, 7), date(2001, 7, 8), date(2001, 7, 7) + timedelta(weeks=64), None]
    once = [(key, day) for key in ("a", "b", None) for day in days]
    once += [("weekly", date(1998, 1, 3) + timedelta(weeks=n)) for n in range(300)]
    schema = "key string, day date"
    assert quality.repeated_days(spark.createDataFrame(once, schema), ["key"], "day").isEmpty()
    for row in [*once[:15], once[20], once[-1]]:
        df = spark.createDataFrame([*once, row], schema)
        assert not quality.duplicate_keys(df, ["key", "day"]).isEmpty()
        assert quality.repeated_days(df, ["key"], "day").count() == 1


def test_weekly_rows_are_not_moved_one_by_one_to_find_repeated_ones(spark):
    weeks = spark.range(0, 6000, 1, 2).selectExpr("string(id % 30) AS key", "date_add(date'1998-01-03', int(7 * (id div 30))) AS day")
    assert weeks.distinct().count() == 6000
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert max(_shuffled(quality.duplicate_keys(weeks, ["key", "day"]))) == 6000
        assert max(_shuffled(quality.repeated_days(weeks, ["key"], "day"))) <= 2 * 30 * 5
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
