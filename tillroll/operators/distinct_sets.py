"""Exact distinct counts that can be merged: sets of integers as 64-bit words.

Counts of distinct values cannot be added up (a transaction may be in several groups); sets can be
merged by ``bit_or``, map-side, and counted last. A row holds the values of one block of 64, so a set
has at most one row per value where values are scattered and a 64th of that where they are dense;
the 4 KB bitmaps of ``bitmap_construct_agg`` would hold a few bits each for a single card.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK, BITS = "block", "bits"


def distinct_sets(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The values per group as rows (keys, block, bits). ``value`` is an integer column; its NULLs belong to
    no set, but a group of NULLs alone keeps a row, so that it counts 0 as in COUNT(DISTINCT)."""
    wide = F.col(value).cast("bigint")
    # By an expression, since the place to shift to varies by row.
    bit = F.expr(f"shiftleft(1L, CAST(CAST(`{value}` AS bigint) & 63 AS int))")
    return rows.groupBy(*keys, F.shiftright(wide, 6).alias(BLOCK)).agg(F.bit_or(bit).alias(BITS))


def merged_sets(sets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Unions over ``keys``. A busy group is spread by its blocks."""
    return sets.groupBy(*keys, BLOCK).agg(F.bit_or(BITS).alias(BITS))


def set_sizes(sets: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Distinct values of each union over ``keys``."""
    size = F.sum(F.coalesce(F.bit_count(BITS), F.lit(0))).cast("bigint")
    return merged_sets(sets, keys).groupBy(*keys).agg(size.alias(name))
