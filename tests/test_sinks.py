from __future__ import annotations

import glob
import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tillroll.functions.retail import cast_timestamps
from tillroll.operators import quality
from tillroll.sources import sinks, star, tables


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_full_refresh_replaces_rows_and_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.full_refresh(spark.range(5).toDF("a"), path)
    sinks.full_refresh(spark.createDataFrame([("x", 1)], "b string, c int"), path)
    assert _rows(tables.read_table(spark, path).select("b", "c")) == [("x", 1)]


def test_a_failed_refresh_leaves_the_former_table_whole(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.full_refresh(spark.range(5).toDF("a"), path)
    fails = spark.range(100, numPartitions=4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("a"))
    with pytest.raises(Exception, match="no"):
        sinks.full_refresh(fails, path)
    assert tables.read_table(spark, path).count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_any_installed_table_format_will_do(spark, tmp_path):
    path = str(tmp_path / "t")
    back = sinks.stored(spark.range(3).toDF("a"), path, fmt="orc")
    assert glob.glob(f"{path}/*.orc") and _rows(back) == [(0,), (1,), (2,)]
    assert sinks.publish(spark, "shop_test", "orc_table", path, fmt="orc").count() == 3
    spark.sql("DROP DATABASE shop_test CASCADE")


def test_partitioned_table_reads_only_the_dates_asked_for(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.range(40).select(F.date_add(F.lit(date(2001, 1, 1)), (F.col("id") % 4).cast("int")).alias("day"), "id")
    back = sinks.stored(days, path, "day")
    assert back.columns == ["day", "id"]
    assert _rows(back) == _rows(days)
    pruned = back.filter(F.col("day") == date(2001, 1, 2))
    assert pruned.count() == 10
    assert re.search(r"PartitionFilters: \[isnotnull\(day", pruned._jdf.queryExecution().executedPlan().toString())


def test_a_date_with_most_rows_is_written_by_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    try:
        rows = spark.range(0, 400_000, 1, 8).select(
            F.when(F.col("id") % 3 > 0, F.lit(date(2001, 1, 6))).otherwise(F.lit(date(2001, 1, 13))).alias("day"),
            F.xxhash64("id").alias("v"),
        )
        sinks.full_refresh(rows, str(tmp_path / "t"), "day")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    assert len(glob.glob(f"{tmp_path}/t/day=2001-01-06/*.parquet")) > 4


def test_publish_creates_an_external_table_again_and_again(spark, tmp_path):
    flat, dated = str(tmp_path / "flat"), str(tmp_path / "dated")
    sinks.full_refresh(spark.range(3), flat)
    sinks.full_refresh(spark.range(6).withColumn("d", F.lit(date(2001, 1, 6))), dated, "d")
    for _ in range(2):
        assert sinks.publish(spark, "shop_test", "flat", flat).count() == 3
        assert sinks.publish(spark, "shop_test", "dated", dated).count() == 6
    spark.sql("DROP TABLE shop_test.flat")
    assert tables.read_table(spark, flat).count() == 3
    spark.sql("DROP DATABASE shop_test CASCADE")


def test_report_is_appended_as_one_csv_with_header(spark, tmp_path):
    executed = datetime(2001, 8, 1, 6, 7, 8)
    verdicts = [quality.passed_if_empty(name, spark.range(0)) for name in ("one", "two")]
    report = quality.report({"t": verdicts}, executed)
    path = sinks.append_report(report, str(tmp_path), executed)
    assert path == f"{tmp_path}/2001/08/01/test_results_20010801.csv"
    assert len(glob.glob(f"{path}/part-*.csv")) == 1
    sinks.append_report(report, str(tmp_path), executed)
    back = spark.read.option("header", True).csv(path)
    assert back.columns == quality.RESULT_COLUMNS
    assert _rows(back.distinct()) == [("t", "Pass", n, "2001-08-01 06:07:08") for n in ("one", "two")]
    assert back.count() == 4


def test_scratch_tables_live_under_the_configured_folder(spark):
    folder = sinks.scratch_folder(spark)
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert folder != sinks.scratch_folder(spark)


def test_stored_star_tables_can_be_read_back(spark, tmp_path):
    gold = star.gold(spark, "/root/testdata/sf0.001")
    for name, df in vars(gold).items():
        sinks.full_refresh(df, f"{tmp_path}/{name}")
    again = tables.read_gold(spark, str(tmp_path))
    assert {name: df.schema.simpleString() for name, df in vars(again).items()} == {
        name: df.schema.simpleString() for name, df in vars(gold).items()
    }


def test_cast_timestamps(spark):
    texts = spark.createDataFrame([("2001-08-01 01:02:03", "x", None)], "a string, b string, c string")
    df = cast_timestamps(texts, ["a", "c"])
    assert [f.dataType.simpleString() for f in df.schema] == ["timestamp", "string", "timestamp"]
    assert df.first().a == datetime(2001, 8, 1, 1, 2, 3)
