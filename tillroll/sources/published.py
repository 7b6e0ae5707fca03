"""Catalog tables whose refresh is never seen half done.

Each refresh writes a folder of its own; then the catalog entry is pointed at it, one change of one
record. Nothing is renamed, so it is the same on object stores. Readers use the table's name: a query
reads the version that was current when it was planned, whose folder outlives ``KEPT`` more refreshes.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tillroll.sources.sinks import delete, file_system, write_table

# Versions before the current one that stay for readers that have planned on them.
KEPT = 2
# Where it is off as a table is created, partitions are found in the table's folder rather than
# registered one by one, each with a place of its own.
_REGISTERED_PARTITIONS = "spark.sql.hive.manageFilesourcePartitions"


def publish_version(
    df: DataFrame,
    database: str,
    table: str,
    base: str,
    partition_by: str | None = None,
    fmt: str = "parquet",
    last: Callable[[DataFrame], DataFrame] = lambda df: df,
    kept: int = KEPT,
) -> DataFrame:
    """Write ``df`` as the new version of a catalog table below the folder ``base`` and switch to it.

    If writing fails, the folder is removed and the former version stays. With the same columns the
    switch is one ``ALTER TABLE``; other columns need a new entry, and only then there is a moment
    without the table. One refresh of a table is to run at a time.
    """
    spark, name = df.sparkSession, f"{database}.{table}"
    folder = f"{base.rstrip('/')}/v-{time.time_ns():020d}-{uuid.uuid4().hex}"
    try:
        write_table(df, folder, partition_by, fmt, last)
    except Exception:
        delete(spark, folder)
        raise
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    found = spark.read.format(fmt).load(folder)
    if spark.catalog.tableExists(name) and _same_layout(spark, name, found, partition_by):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        with _partitions_by_folder(spark):
            spark.catalog.createTable(name, path=folder, source=fmt)
    for old in versions(spark, base)[: -kept - 1]:
        delete(spark, f"{base.rstrip('/')}/{old}")
    return spark.table(name)


def versions(spark: SparkSession, base: str) -> list[str]:
    """Names of the version folders below ``base``, oldest first."""
    files, place = file_system(spark, base)
    names = [status.getPath().getName() for status in files.listStatus(place) if status.isDirectory()]
    return sorted(name for name in names if name.startswith("v-"))


def catalog_folder(spark: SparkSession, name: str) -> str:
    """The folder that a catalog table points to now."""
    return spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first()["data_type"]


def _same_layout(spark: SparkSession, name: str, found: DataFrame, partition_by: str | None) -> bool:
    columns = spark.catalog.listColumns(name)
    partitions = [column.name for column in columns if column.isPartition]
    here = [(field.name, field.dataType) for field in spark.table(name).schema]
    return here == [(field.name, field.dataType) for field in found.schema] and partitions == ([partition_by] if partition_by else [])


@contextmanager
def _partitions_by_folder(spark: SparkSession):
    before = spark.conf.get(_REGISTERED_PARTITIONS, "true")
    spark.conf.set(_REGISTERED_PARTITIONS, "false")
    try:
        yield
    finally:
        spark.conf.set(_REGISTERED_PARTITIONS, before)
