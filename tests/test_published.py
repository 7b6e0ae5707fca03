from __future__ import annotations

import glob
import threading
from datetime import date

import pytest
from pyspark.sql import functions as F

from tillroll.sources.published import publish_version, versions


@pytest.fixture
def database(spark):
    yield "shop_versions"
    spark.sql("DROP DATABASE IF EXISTS shop_versions CASCADE")


def _days(spark, n, version):
    day = F.date_add(F.lit(date(2001, 1, 1)), (F.col("id") % 3).cast("int"))
    return spark.range(n).select("id", F.lit(version).alias("version"), day.alias("day"))


@pytest.mark.parametrize("partition_by", [None, "day"])
def test_a_reader_never_fails_or_sees_two_versions(spark, tmp_path, database, partition_by):
    publish_version(_days(spark, 90, 0), database, "t", str(tmp_path), partition_by)
    seen, errors, done = [], [], threading.Event()

    def read():
        while not done.is_set():
            try:
                row = spark.table(f"{database}.t").agg(F.min("version"), F.max("version"), F.count("*")).first()
                seen.append(tuple(row))
            except Exception as error:
                errors.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for version in range(1, 8):
        publish_version(_days(spark, 90, version), database, "t", str(tmp_path), partition_by)
    done.set()
    reader.join()
    assert not errors, errors[0]
    assert seen and all(low == high and n == 90 for low, high, n in seen)
    assert spark.table(f"{database}.t").agg(F.max("version")).first()[0] == 7
    assert len(versions(spark, str(tmp_path))) == 3


def test_partitions_that_are_gone_are_gone(spark, tmp_path, database):
    publish_version(_days(spark, 90, 0), database, "t", str(tmp_path), "day")
    back = publish_version(_days(spark, 2, 1), database, "t", str(tmp_path), "day")
    assert {row.day for row in back.collect()} == {date(2001, 1, 1), date(2001, 1, 2)}
    pruned = back.filter(F.col("day") == date(2001, 1, 2))
    assert "PartitionFilters: [isnotnull(day" in pruned._jdf.queryExecution().executedPlan().toString()


def test_other_columns_or_another_layout_make_a_new_entry(spark, tmp_path, database):
    publish_version(spark.range(3), database, "t", str(tmp_path))
    back = publish_version(_days(spark, 6, 1), database, "t", str(tmp_path), "day")
    assert back.columns == ["id", "version", "day"] and back.count() == 6
    assert publish_version(_days(spark, 7, 1), database, "t", str(tmp_path)).count() == 7


def test_a_failed_write_leaves_the_former_version(spark, tmp_path, database):
    publish_version(spark.range(5), database, "t", str(tmp_path))
    bad = spark.range(9).select(F.when(F.col("id") == 8, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        publish_version(bad, database, "t", str(tmp_path))
    assert spark.table(f"{database}.t").count() == 5
    assert len(glob.glob(f"{tmp_path}/*")) == 1
