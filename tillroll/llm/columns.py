"""Small helpers for tables whose other columns may have any name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores after it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def rows_of(docs: DataFrame, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows of ``docs`` whose doc_id, null or not, is (``left_anti``: is not) among those of ``ids``."""
    wanted = free_name(docs, "wanted_id")
    ids = ids.select(F.col("doc_id").alias(wanted)).distinct()
    return docs.join(ids, F.col("doc_id").eqNullSafe(F.col(wanted)), how)
