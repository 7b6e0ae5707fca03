"""The input tables of the jobs.

Parquet by default; any file-based table format installed on the cluster can be named instead.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class GoldTables:
    """Star schema: one fact and its dimensions, joined on ``*_hk`` surrogate keys."""

    retail_sale_fact: DataFrame
    location_dim: DataFrame
    item_dim: DataFrame
    register_dim: DataFrame
    customer_dim: DataFrame


@dataclass(frozen=True)
class SilverTables:
    """Long-history sales and versioned dimensions on natural keys."""

    retail_sale: DataFrame
    customer: DataFrame
    item: DataFrame
    location: DataFrame


def read_table(spark: SparkSession, path: str, schema: str | None = None, fmt: str = "parquet") -> DataFrame:
    reader = spark.read.format(fmt)
    return (reader if schema is None else reader.schema(schema)).load(path)


def read_gold(spark: SparkSession, base: str, fmt: str = "parquet") -> GoldTables:
    return GoldTables(**{f.name: read_table(spark, f"{base}/{f.name}", fmt=fmt) for f in fields(GoldTables)})


def read_silver(spark: SparkSession, base: str, fmt: str = "parquet") -> SilverTables:
    return SilverTables(**{f.name: read_table(spark, f"{base}/{f.name}", fmt=fmt) for f in fields(SilverTables)})
