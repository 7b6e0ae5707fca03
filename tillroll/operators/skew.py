"""Joining rows to a dimension on a key that may hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is busy if it holds more than one in so many rows, so there are fewer busy keys than this.
BUSY_SHARE = 1000
# Parts that the rows of a busy key are spread over.
SPREAD = 64


def busy_keys(rows: DataFrame, key: str) -> DataFrame:
    """Keys with more than a thousandth of all rows: fewer than a thousand, however many rows there are."""
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_rows"))
    total = counts.agg(F.sum("_rows")).scalar()
    return counts.filter(F.col("_rows") * BUSY_SHARE > total).select(key)


def join_spread(
    rows: DataFrame, dimension: DataFrame, key: str, spread_by: Sequence[str], busy: DataFrame | None = None
) -> DataFrame:
    """Inner join on ``key`` in which the rows of a busy key are spread by the hash of other columns.

    Only a busy key's rows of the dimension are repeated, ``SPREAD`` times. The list of busy keys is
    broadcast: it is shorter than ``BUSY_SHARE`` whatever the data. ``busy`` may be a result of
    ``busy_keys`` over other rows with the same busy keys that are cheaper to count.
    """
    busy = F.broadcast((busy_keys(rows, key) if busy is None else busy).withColumn("_busy", F.lit(True)))
    part = F.pmod(F.xxhash64(*spread_by), F.lit(SPREAD)).cast("int")
    parts = F.when(F.col("_busy"), F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0)))
    spread = rows.join(busy, key, "left").withColumn("_part", F.when(F.col("_busy"), part).otherwise(0)).drop("_busy")
    repeated = dimension.join(busy, key, "left").withColumn("_part", F.explode(parts)).drop("_busy")
    return spread.join(repeated, [key, "_part"]).drop("_part")
