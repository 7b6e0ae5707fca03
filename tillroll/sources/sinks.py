"""Writing results: full-refresh tables, catalog publication, check reports, scratch tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from datetime import date, datetime

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from tillroll.sources.tables import read_table


def full_refresh(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    fmt: str = "parquet",
    last: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> None:
    """Replace the table at ``path``, schema included, once the new one is written whole: if writing
    fails, the former table stays as it is.

    A partitioned table is first rebalanced on its partition column: a date gets few large files,
    and a date with very many rows is split over several tasks instead of landing in one. ``last`` is
    put on the rows as they go to the writer (see ``quality.counting``), moved and sorted already.
    """
    if fmt not in PLAIN_FORMATS:
        _writer(df, partition_by, last).format(fmt).mode("overwrite").option("overwriteSchema", True).save(path)
        return
    staged = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    try:
        write_table(df, staged, partition_by, fmt, last)
    except Exception:
        delete(df.sparkSession, staged)
        raise
    _swap(df.sparkSession, staged, path.rstrip("/"))


def _writer(df: DataFrame, partition_by: str | None, last: Callable[[DataFrame], DataFrame]) -> DataFrameWriter:
    if partition_by is None:
        return last(df).write
    # Sorted as the writer needs them, but before ``last``, which may widen the rows.
    return last(df.hint("rebalance", partition_by).sortWithinPartitions(partition_by)).write.partitionBy(partition_by)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    fmt: str = "parquet",
    last: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> None:
    """Write a table to a folder that does not exist yet, laid out as ``full_refresh`` has it."""
    _writer(df, partition_by, last).format(fmt).save(path)


def refresh_partitions(df: DataFrame, path: str, partition_by: str, days: Sequence[date], fmt: str = "parquet") -> None:
    """Replace the partitions of ``days`` in a stored table by the rows ``df`` has for them; a day without
    rows loses its partition. All others keep their files. Partitions take their places once all of
    ``df`` is written; what ``df`` reads must not be the table itself.
    """
    written = Observation(f"days-{uuid.uuid4().hex}")
    counts = [F.count_if(F.col(partition_by) == day).alias(day.isoformat()) for day in days]
    writer = _writer(df, partition_by, lambda rows: rows.observe(written, *counts) if counts else rows)
    writer.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").save(path)
    for day in days:
        if not written.get[day.isoformat()]:
            delete(df.sparkSession, f"{path.rstrip('/')}/{partition_by}={day.isoformat()}")


# Formats that are folders of files, without commits of their own.
PLAIN_FORMATS = ("parquet", "orc", "json", "csv", "avro")


def file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = file_system(spark, path)
    return files.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    files, place = file_system(spark, path)
    files.delete(place, True)


def _swap(spark: SparkSession, staged: str, path: str) -> None:
    """Put a finished folder in the place of a table; the former one goes last.

    A reader finds the former table, for the time of two renames none, then the new one; never a
    half-written one. If the second rename fails, the former table is put back.
    """
    files, new = file_system(spark, staged)
    _, place = file_system(spark, path)
    _, former = file_system(spark, f"{path}.old-{uuid.uuid4().hex}")
    had = files.exists(place)
    if had and not files.rename(place, former):
        raise OSError(f"cannot move {path}")
    if not files.rename(new, place):
        if had:
            files.rename(former, place)
        raise OSError(f"cannot move {staged} to {path}")
    if had:
        files.delete(former, True)


def publish(spark: SparkSession, database: str, table: str, path: str, fmt: str = "parquet") -> DataFrame:
    """(Re-)create an external catalog table over the files at ``path``."""
    name = f"{database}.{table}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=path, source=fmt)
    if any(column.isPartition for column in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def report_path(base: str, executed: datetime) -> str:
    return f"{base}/{executed:%Y/%m/%d}/test_results_{executed:%Y%m%d}.csv"


def append_report(report: DataFrame, base: str, executed: datetime) -> str:
    """Append a check report (one row per check) as a single CSV file with a header."""
    path = report_path(base, executed)
    report.coalesce(1).write.mode("append").option("header", True).csv(path)
    return path


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below the shared checkpoint folder of the cluster.

    Only where none is configured (local runs) a temporary folder stands in for it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        shared = tempfile.mkdtemp(prefix="tillroll-")
        spark.sparkContext.setCheckpointDir(shared)
        shared = spark.sparkContext.getCheckpointDir()
    return f"{shared.rstrip('/')}/tables-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A scratch folder that is removed in the end; what reads it has to be done by then."""
    folder = scratch_folder(spark)
    try:
        yield folder
    finally:
        delete(spark, folder)


def stored(df: DataFrame, path: str, partition_by: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Write a table and hand back a scan of it, so later steps neither recompute it nor depend on
    blocks held by an executor. Column order is kept (partition columns otherwise move to the end)."""
    full_refresh(df, path, partition_by, fmt)
    return read_table(df.sparkSession, path, fmt=fmt).select(*[F.col(name) for name in df.columns])
