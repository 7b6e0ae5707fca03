"""Exact copies by distributed MSD radix partitioning: groups split by successive bytes, no digests.

All rows start in one group. Level by level the next bytes of each open text are compared, and a group
splits by them; a group of one row, or whose texts have ended, is finished. A level takes the next
``FIRST_BYTES * GROWTH**k`` bytes or so, as radix passes over single bytes would need as many rounds as
the longest text has bytes. What decides is the bytes themselves, never a hash of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm import hashing as H
from tillroll.llm.columns import free_name
from tillroll.llm.store import scratch, stored

#: The first level compares so many bytes; each level ends at GROWTH times the end of the one before.
FIRST_BYTES = 64
GROWTH = 4
#: Ends of all levels; the last is beyond the longest text that a row can hold (2 GB).
ENDS = tuple(FIRST_BYTES * GROWTH**k for k in range(14))
#: A group is busy with more than one in so many rows, hence fewer than so many groups are.
BUSY_SHARE = 1000
#: Parts that the rows of a busy group are spread over.
SPREAD = 64


def _pieces(docs: DataFrame, row: Column) -> DataFrame:
    """row, doc_id, text_sha256, size and the bytes of each level (null beyond the end), lower-cased."""
    levels = [f"bytes_{k}" for k in range(len(ENDS))]
    begins = (0, *ENDS[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in H.blocks(batches):
            data, offsets = H.text_bytes(batch.column("text"))
            raw = H.LOWER[data].tobytes()
            texts = [raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            columns = [
                batch.column("row"),
                batch.column("doc_id"),
                pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
            ]
            for begin, end in zip(begins, ENDS, strict=True):
                columns.append(pa.array([t[begin:end] if len(t) > begin or not begin else None for t in texts], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "text_sha256", "size", *levels])

    schema = "row long, doc_id long, text_sha256 string, size long, " + ", ".join(f"{c} binary" for c in levels)
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    return docs.select(row.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text).mapInArrow(run, schema)


def _split(rows: DataFrame, total: int) -> DataFrame:
    """The rows (row, doc_id, group, bytes, ended) of groups of two or more after a level: row, doc_id,
    ended, the new group (its smallest row), its number of rows ``n`` and its largest doc_id ``keep_id``.

    Groups are counted on the map side. To learn its group a row is joined on the bytes; the rows of a
    busy group are spread over parts there. A hash of the bytes marks the busy ones, to keep the list
    that is broadcast short (under ``BUSY_SHARE`` rows of 17 bytes): it decides the part and nothing else.
    """
    key = ["group", "bytes", "ended"]
    mark = ["group", "mark", "ended"]
    with scratch(rows.sparkSession) as folder:
        # Stored, as they are read twice: the bytes of the rows that are still open go to them once a level.
        marked = stored(rows.withColumn("mark", F.xxhash64("bytes")), f"{folder}/rows")
        groups = stored(
            marked.groupBy(*key, "mark")
            .agg(F.count("*").alias("n"), F.min("row").alias("first"), F.max("doc_id").alias("keep_id"))
            .where("n > 1"),
            f"{folder}/groups",
        )
        busy = F.broadcast(groups.where(F.col("n") * BUSY_SHARE > total).select(*mark).distinct().withColumn("busy", F.lit(True)))
        part = F.when(F.col("busy"), F.pmod(F.xxhash64("row"), F.lit(SPREAD)).cast("int")).otherwise(0)
        parts = F.when(F.col("busy"), F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0)))
        spread = marked.join(busy, mark, "left").withColumn("part", part).drop("busy", "mark")
        repeated = groups.join(busy, mark, "left").withColumn("part", F.explode(parts)).drop("busy", "mark")
        found = spread.join(repeated, [*key, "part"])
        return stored(found.select("row", "doc_id", "ended", F.col("first").alias("group"), "n", "keep_id"))


def _classes(pieces: DataFrame) -> DataFrame:
    """The rows of all groups of two or more equal texts: row, doc_id, group, n, keep_id."""
    total = pieces.count()
    finished, still = [], None
    for k, end in enumerate(ENDS):
        level = pieces.select("row", "doc_id", F.col(f"bytes_{k}").alias("bytes"), (F.col("size") <= end).alias("ended"))
        if still is None:
            rows = level.withColumn("group", F.lit(0).cast("long"))
        else:
            # Neither side has a bound, so none is broadcast at any size.
            rows = level.where(F.col("bytes").isNotNull()).join(still.hint("merge"), "row")
        split = _split(rows, total)
        finished.append(split.where("ended").drop("ended"))
        still = split.where("NOT ended").select("row", "group")
        if still.isEmpty():
            break
    equal = finished[0]
    for more in finished[1:]:
        equal = equal.union(more)
    return equal


def _report(pieces: DataFrame) -> DataFrame:
    pieces = stored(pieces)
    equal = _classes(pieces)
    # One row stays even where rows with the largest doc_id are repeated, or all are null.
    stays = equal.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy("group").agg(F.min("row").alias("row"))
    marks = equal.select("row", "n", "keep_id").join(stays.select("row", F.lit(True).alias("stays")), "row", "left")
    rows = pieces.select("row", "doc_id", "text_sha256").join(marks, "row", "left")
    alone = F.col("n").isNull()
    return rows.select(
        "row",
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (alone | F.coalesce("stays", F.lit(False))).alias("kept"),
        "text_sha256",
    )


def copies(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty, so null and empty
    texts are equal. Of equal texts the row with the largest doc_id stays, a null doc_id being smaller
    than any; of repeated rows with that doc_id one stays. The digest is only handed out. An empty table
    gives an empty result; other columns are not read.
    """
    return _report(_pieces(docs, F.monotonically_increasing_id())).drop("row")


def unique(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    row = free_name(docs, "row")
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()))
    kept = _report(_pieces(numbered, F.col(row))).where("kept").select(F.col("row").alias(row))
    return numbered.join(kept, row, "left_semi").select(docs.columns)
