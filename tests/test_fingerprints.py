"""Comparison by fingerprints: equal tables move next to nothing, every difference is found."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tillroll.operators.fingerprints import fingerprints, key_range, row_differences, unequal_ranges

COLUMNS = ["id", "name", "amount"]


@pytest.fixture(scope="module")
def table(spark):
    rows = spark.range(20_000).select("id", F.when(F.col("id") % 7 > 0, F.concat(F.lit("n"), "id")).alias("name"), (F.col("id") * 3).alias("amount"))
    return rows.unionByName(rows.where("id < 50"))


def differences(source, target):
    found = row_differences(source, target, COLUMNS, ["id"])
    return sorted(((r.id, r.name, r.amount, r.source_rows, r.target_rows) for r in found.collect()), key=repr)


def test_equal_tables_in_any_order(table):
    assert differences(table, table.orderBy(F.desc("amount")).repartition(7)) == []
    assert unequal_ranges(table, table.repartition(3), COLUMNS, ["id"], 8).count() == 0
    assert fingerprints(table, COLUMNS, key_range(["id"], 8)).count() == 256


def test_planted_differences(table):
    altered = (
        table.where("id <> 11")
        .withColumn("amount", F.when(F.col("id") == 500, 1).otherwise(F.col("amount")).cast("long"))
        .withColumn("name", F.when(F.col("id") == 601, None).otherwise(F.col("name")))
        .unionByName(table.where("id = 700"))
    )
    assert differences(table, altered) == sorted(
        [
            (11, "n11", 33, 2, 0),
            (500, "n500", 1500, 1, 0),
            (500, "n500", 1, 0, 1),
            (601, "n601", 1803, 1, 0),
            (601, None, 1803, 0, 1),
            (700, None, 2100, 1, 2),
        ],
        key=repr,
    )


def test_swapped_values_and_missing_ones_are_differences(spark):
    schema = "id long, name string, amount long"
    one = spark.createDataFrame([(1, None, 2), (2, "x", None)], schema)
    other = spark.createDataFrame([(2, None, 1), (None, "x", 2)], schema)
    assert len(differences(one, other)) == 4
    assert differences(one.limit(0), one.limit(0)) == [] and len(differences(one, one.limit(0))) == 2


def test_only_rows_of_unequal_ranges_are_compared(spark, table):
    target = table.withColumn("amount", F.when(F.col("id") == 500, 1).otherwise(F.col("amount")).cast("long"))
    ranges = unequal_ranges(table, target, COLUMNS, ["id"], 8)
    assert ranges.count() == 1
    compared = table.withColumn("key_range", key_range(["id"], 8)).join(ranges, "key_range", "left_semi").count()
    assert compared < 200
