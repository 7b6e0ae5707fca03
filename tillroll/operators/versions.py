"""Slowly changing dimensions: pick the version in force for each natural key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_version(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str = "eff_to_dt",
    tie_breakers: Sequence[str] = (),
) -> DataFrame:
    """Keep the row with the greatest ``order_by`` per key; missing dates lose.

    ``tie_breakers`` (greatest first) make the choice repeatable when two versions end on the same
    day. Spark turns the ``rank = 1`` filter into a group limit that runs before the shuffle, so a
    key with very many versions sends at most one row per input partition.
    """
    order = [F.desc_nulls_last(name) for name in (order_by, *tie_breakers)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
