"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.sources.sinks import scratch, scratch_folder

__all__ = ["scratch", "shuffle_partitions", "stored"]


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and go on from the written table: later steps do not
    repeat the work, and a lost executor costs at most a re-read. ``path`` may be a folder of
    ``scratch``, which is removed when its block ends."""
    path = path or scratch_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
