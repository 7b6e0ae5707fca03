from __future__ import annotations

from datetime import date, datetime

from tests.small_tables import CURRENT, gold
from tillroll.domain import TABLE_COLUMNS
from tillroll.operators.versions import latest_version
from tillroll.plans.checks import household_types_recomputed
from tillroll.plans.household_types import household_type, household_types

CUSTOMERS = [
    (1, "1", "mixed-null", None, CURRENT), (2, "2", "mixed-null", "Customer Card", CURRENT),
    (3, "3", "unknown", "Unknown", CURRENT),
    (4, "4", "alias", "VMore Cards", CURRENT), (5, "5", "alias", "Customer Card", CURRENT),
    (6, "6", "two", "Manager Cards", CURRENT), (7, "7", "two", "Training Cards", CURRENT), (8, "8", "two", None, CURRENT),
    (9, "9", "changed", "Manager Cards", date(2000, 1, 1)), (10, "9", "changed", "Community Cards", CURRENT),
    (11, "0", "anonymous", "Gift Cards", CURRENT), (12, "12", None, "Training Cards", CURRENT),
    (13, "13", "null-only", None, CURRENT), (14, "14", "unknown-null", "Unknown", CURRENT),
    (15, "15", "unknown-null", None, CURRENT),
]
EXPECTED = {
    ("mixed-null", None), ("mixed-null", "Customer"), ("unknown", "Other"), ("alias", "Customer"), ("two", "Other"),
    ("changed", "Community"), ("anonymous", "Gift Cards"), (None, "Training"), ("null-only", None),
    ("unknown-null", "Other"), ("unknown-null", None),
}


def test_types(spark):
    customers = gold(spark, [], CUSTOMERS).customer_dim
    df = household_type(customers, datetime(2001, 8, 1))
    rows = df.collect()
    assert len(rows) == len(EXPECTED)
    assert {(r.hhn, r.hh_type) for r in rows} == EXPECTED
    assert df.columns == TABLE_COLUMNS["household_type"]


def test_recomputation_by_grouping_agrees(spark):
    customers = gold(spark, [], CUSTOMERS).customer_dim
    one, other = household_types(customers), household_types_recomputed(customers)
    assert one.exceptAll(other).count() == other.exceptAll(one).count() == 0


def test_latest_version_breaks_ties_and_puts_missing_dates_last(spark):
    df = spark.createDataFrame(
        [("a", 1, date(2000, 1, 1)), ("a", 2, None), ("b", 3, CURRENT), ("b", 4, CURRENT), ("c", 5, None)],
        "k string, id int, eff_to_dt date",
    )
    assert {r.k: r.id for r in latest_version(df, ["k"], tie_breakers=["id"]).collect()} == {"a": 1, "b": 4, "c": 5}
