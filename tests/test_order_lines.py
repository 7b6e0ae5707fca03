"""Sales that are read several times are joined once."""

from __future__ import annotations

from datetime import datetime

import pytest

from tillroll.operators.key_filters import join_few
from tillroll.sources import star


@pytest.fixture
def folder(spark, tmp_path):
    days = [datetime(2001, 7, 1, 9, 30), datetime(2000, 2, 29), None]
    orders = [(1, 10, "F", 1.0, days[0], "1"), (2, 11, "O", 2.0, days[1], "2"), (2, 12, "O", 2.0, days[2], "2"), (None, 13, "O", 2.0, days[0], "2")]
    lines = [(n % 3 + 1 if n else None, n % 4, 1, n % 8, 2.0, 10.5, 0.1, 0.02 * (n % 2), "ANR"[n % 3], "F", days[0]) for n in range(12)]
    for name, rows in (("orders", orders), ("lineitem", lines)):
        spark.createDataFrame(rows, star.SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    return tmp_path


def _sales(raw):
    raw.customer, raw.supplier, raw.part = (raw.spark.createDataFrame([], star.SCHEMAS[n]) for n in ("customer", "supplier", "part"))
    return star.retail_sale_fact(raw), star.silver_of(raw).retail_sale


def test_stored_lines_give_the_same_sales_without_joining_again(spark, folder):
    plain = _sales(star.RawTables(spark, str(folder)))
    once = _sales(star.RawTables(spark, str(folder), f"{folder}/scratch"))
    for a, b in zip(plain, once, strict=True):
        assert a.schema == b.schema
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())) and a.count() > 4
        assert "Join" in a._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in b._jdf.queryExecution().optimizedPlan().toString()


def test_lines_of_other_stores_are_dropped_before_orders_are_joined(spark, folder):
    raw = star.RawTables(spark, str(folder))
    raw.customer, raw.supplier, raw.part = (spark.createDataFrame([], star.SCHEMAS[n]) for n in ("customer", "supplier", "part"))
    sales, older = star.retail_sale_fact(raw), star.silver_of(raw).retail_sale
    stores = spark.createDataFrame([(1, "SOF"), (1, "BLF"), (9, "SOF"), (None, "SOF")], "store bigint, banner string")
    for df, key in ((sales, "location_hk"), (older, "store_number")):
        named = stores.withColumnRenamed("store", key)
        found = join_few(df, named, key)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("l_orderkey") < plan.index("LeftSemi")
        # Stores that repeat count each time, as in the plain join.
        assert sorted(map(str, found.collect())) == sorted(map(str, df.join(named, key).collect()))
        assert found.count() == 2 * df.count() > 8
