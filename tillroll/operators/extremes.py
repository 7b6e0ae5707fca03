"""First and last dates per scope: a narrow aggregation, then a pivot of its result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_last(df: DataFrame, keys: Sequence[str], day: str, parts: Mapping[str, Column]) -> DataFrame:
    """Per key the first and last ``day`` of each part, a part being the rows that meet its condition."""
    edges = []
    for part, selected in parts.items():
        edges.append(F.min(F.when(selected, F.col(day))).alias(f"{part}_first"))
        edges.append(F.max(F.when(selected, F.col(day))).alias(f"{part}_last"))
    return df.groupBy(*keys).agg(*edges)


def pivot_first_last(
    df: DataFrame, key: str, parts: Sequence[str], scopes: Mapping[str, Column], suffix: str
) -> DataFrame:
    """Per key, scope and part the earliest first and latest last day among the rows the scope selects.

    ``df`` has few rows per key by now (see ``first_last``). They move to their key as they are;
    pivoting on both sides of the shuffle would send each of them as a row of all the scopes.
    """
    edges = []
    for scope, selected in scopes.items():
        for part in parts:
            first, last = (F.when(selected, F.col(f"{part}_{edge}")) for edge in ("first", "last"))
            edges.append(F.min(first).alias(f"{scope}_{part}_first_{suffix}"))
            edges.append(F.max(last).alias(f"{scope}_{part}_last_{suffix}"))
    return df.repartition(key).groupBy(key).agg(*edges)


def merge_first_last(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Combine ready first/last columns over a coarser key; the column name says which edge it is."""
    return df.groupBy(key).agg(
        *[(F.min(name) if "_first_" in name else F.max(name)).alias(name) for name in columns]
    )


def overall(df: DataFrame, prefix: str, parts: Sequence[str], suffix: str) -> DataFrame:
    """Earliest first and latest last day over several scopes; scopes without a date are skipped."""
    return df.withColumns(
        {
            f"{prefix}_first_{suffix}": F.least(*[F.col(f"{part}_first_{suffix}") for part in parts]),
            f"{prefix}_last_{suffix}": F.greatest(*[F.col(f"{part}_last_{suffix}") for part in parts]),
        }
    )
