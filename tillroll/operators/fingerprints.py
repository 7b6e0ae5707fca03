"""Comparing two large tables by fingerprints of key ranges, reading rows only where they differ."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Leading bits of the key hash that name a range, level by level: 256 ranges, then 256 in each unequal one.
LEVELS = (8, 16)


def row_hash(columns: Sequence[str]) -> Column:
    """64-bit hash of a row. A missing value is marked, as the hash functions skip it otherwise."""
    return F.xxhash64(*columns, *[F.col(name).isNull() for name in columns])


def key_range(keys: Sequence[str], bits: int) -> Column:
    return F.shiftrightunsigned(row_hash(keys), 64 - bits)


def fingerprints(df: DataFrame, columns: Sequence[str], key_ranges: Column) -> DataFrame:
    """Per range: rows, xor and sum of their hashes, whatever their order. Formed before the shuffle, so
    a partition sends as many rows as there are ranges."""
    both = df.select(key_ranges.alias("key_range"), row_hash(columns).alias("_h"))
    low, high = F.col("_h").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftright("_h", 32)
    return both.groupBy("key_range").agg(
        F.count("*").alias("rows"), F.bit_xor("_h").alias("mixed"), F.sum(low).alias("low"), F.sum(high).alias("high")
    )


def unequal_ranges(
    source: DataFrame, target: DataFrame, columns: Sequence[str], keys: Sequence[str], bits: int
) -> DataFrame:
    """Ranges of keys whose rows differ between the two tables; 2**bits at most."""
    here = fingerprints(source, columns, key_range(keys, bits))
    there = fingerprints(target, columns, key_range(keys, bits))
    marks = ["rows", "mixed", "low", "high"]
    other = there.select("key_range", *[F.col(name).alias(f"_{name}") for name in marks])
    same = reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in marks])
    return here.join(other, "key_range", "full").where(~same).select("key_range")


def row_differences(
    source: DataFrame, target: DataFrame, columns: Sequence[str], keys: Sequence[str], levels: Sequence[int] = LEVELS
) -> DataFrame:
    """Rows over ``columns`` whose number differs, with ``source_rows`` and ``target_rows``.

    Both tables are first summed up by ranges of their ``keys``; then only the unequal ranges are cut
    finer, and only the rows of ranges that are unequal in the end are shuffled. Equal tables exchange
    2**8 rows a partition. Missing values compare equal. Ranges with equal count, xor and sum of
    64-bit hashes are taken for equal.
    """
    sides = {"source_rows": source.select(*columns), "target_rows": target.select(*columns)}
    for bits in levels:
        ranges = F.broadcast(unequal_ranges(*sides.values(), columns, keys, bits))
        sides = {
            name: side.withColumn("key_range", key_range(keys, bits)).join(ranges, "key_range", "left_semi").drop("key_range")
            for name, side in sides.items()
        }
    marked = [
        side.select(*columns, *[F.lit(int(name == other)).alias(other) for other in sides]) for name, side in sides.items()
    ]
    counts = marked[0].unionByName(marked[1]).groupBy(*columns).agg(*[F.sum(name).alias(name) for name in sides])
    return counts.where(F.col("source_rows") != F.col("target_rows"))
