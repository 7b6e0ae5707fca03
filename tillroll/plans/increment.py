"""Refreshing the daily card table for the days whose input changed.

Beside the table lie the marks of the input it was built from: count, xor and sum of row hashes for each
day of sales and for each dimension. One pass over the columns that are used gives the marks of
today, without a join and with one row a day after the map side; only days whose marks differ are built
again. A changed dimension changes every day.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.calendar import DailyBounds
from tillroll.operators.fingerprints import fingerprints
from tillroll.plans.daily_sales import pos_daily_agg_card
from tillroll.plans.refresh import Store
from tillroll.sources.sinks import exists, full_refresh, refresh_partitions, scratch, stored
from tillroll.sources.tables import read_table

TABLE, DAY = "pos_daily_agg_card", "fiscal_date"
# Columns the table is built from.
_SALES = [
    DAY, "transaction_number", "customer_hk", "location_hk", "item_hk", "register_hk", "ecomm_flag",
    "merch_sales", "merch_scan_margin", "unit_count", "item_count",
]
_DIMENSIONS = {
    "location_dim": ["location_hk", "current_banner_short_name"],
    "item_dim": ["item_hk", "current_financial_sale_flag"],
    "register_dim": ["register_hk", "id"],
}
_MARKS = ["rows", "mixed", "low", "high"]


def input_marks(store: Store) -> DataFrame:
    """Marks (``part``: a day or the name of a dimension) of what the daily card table is built from."""
    bounds = DailyBounds.of(store.as_of.date())
    sales = store.gold.retail_sale_fact.filter(F.col(DAY).between(bounds.first_day, bounds.last_day))
    parts = [fingerprints(sales, _SALES, F.col(DAY).cast("string"))]
    for name, columns in _DIMENSIONS.items():
        parts.append(fingerprints(getattr(store.gold, name), columns, F.lit(name)))
    banners = ",".join(store.settings.daily_banners)
    chosen = store.spark.range(1).select(F.lit(f"banners {banners}").alias("key_range"), *[F.lit(0).cast(part.dataType).alias(part.name) for part in parts[0].schema[1:]])
    marks = reduce(DataFrame.unionByName, [*parts, chosen])
    return marks.select(F.col("key_range").alias("part"), *_MARKS)


def changed_parts(marks: DataFrame, former: DataFrame) -> list[str]:
    """Parts that are new, gone or different: at most one per day, and a few more."""
    same = reduce(lambda a, b: a & b, [F.col(f"n.{name}").eqNullSafe(F.col(f"f.{name}")) for name in _MARKS])
    both = marks.alias("n").join(former.alias("f"), F.col("n.part") == F.col("f.part"), "full")
    return [row.part for row in both.where(~same).select(F.coalesce("n.part", "f.part").alias("part")).collect()]


def refresh_daily(store: Store, days: Sequence[date] | None = None) -> list[date] | None:
    """Bring the stored daily card table up to date and return the days that were built again or removed;
    None stands for all: the table or its marks were missing, or a dimension or the banners changed.

    ``days`` names the changed days where the caller knows them: the sales of other days are then not
    read, and marks are left as they are. Days outside the period of the table are removed. Rows of
    other days keep their files and their load date. A run that is cut short leaves the former marks, so
    the next one builds the same days again.
    """
    if TABLE in store.databases:
        raise ValueError(f"{TABLE} is kept in versions, which do not change")
    if store.layout.get(TABLE) != DAY:
        raise ValueError(f"{TABLE} is not partitioned by {DAY}")
    path, marks_path = store.path(TABLE), store.path(f"marks/{TABLE}")
    if days is not None:
        _rebuild(store, path, days)
        return sorted(days)
    with scratch(store.spark) as folder:
        marks = stored(input_marks(store), folder)
        changed = None
        if exists(store.spark, path) and exists(store.spark, marks_path):
            parts = changed_parts(marks, read_table(store.spark, marks_path))
            if all(part[:1].isdigit() for part in parts):
                changed = sorted(date.fromisoformat(part) for part in parts)
        if changed is None:
            store.refresh_counting([TABLE])
        else:
            _rebuild(store, path, changed)
        full_refresh(marks, marks_path)
    return changed


def _rebuild(store: Store, path: str, days: Sequence[date]) -> None:
    if not days:
        return
    sales = store.gold.retail_sale_fact.filter(F.col(DAY).isin(list(days)))
    rows = pos_daily_agg_card(replace(store.gold, retail_sale_fact=sales), store.as_of, store.settings.daily_banners)
    refresh_partitions(rows, path, DAY, days, store.fmt)
