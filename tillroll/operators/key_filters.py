"""Runtime Bloom filters for joins of facts with keys that are too many to be broadcast.

Spark makes such a filter of the smaller side and drops facts without a partner before they are shuffled, but only of
sides up to 10 MB, which are broadcast anyway. Here sides up to 4 GB make one; it takes 8 MB itself, whatever their
size. Whether a join gets one is left to Spark: the facts must be large, and the keys selected by a predicate.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_PREFIX = "spark.sql.optimizer.runtime.bloomFilter."
#: Up to 10 million keys let about 4 % of the other facts pass; more keys, more facts, never a wrong row.
SETTINGS = {
    f"{_PREFIX}enabled": "true",
    f"{_PREFIX}creationSideThreshold": "4g",
    f"{_PREFIX}expectedNumItems": "10000000",
    f"{_PREFIX}maxNumItems": "10000000",
    f"{_PREFIX}numBits": str(8 * 2**23),
    # A shuffled join whose smaller side turns out to have no larger partition hashes it instead of sorting both sides.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
}


def join_few(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Inner join of facts with a narrow dimension that is small beside them, like the stores of a retailer.

    The dimension is sent to the facts. Its keys alone are sent first: unlike an inner join, Spark moves that semi join
    below the joins that make the facts, so facts of other keys are dropped as they are read and never shuffled.
    """
    return facts.join(F.broadcast(dimension.select(key)), key, "left_semi").join(F.broadcast(dimension), key)


@contextmanager
def key_filters(spark: SparkSession) -> Iterator[None]:
    """Plan what is run inside with these settings; those the session has set itself stay."""
    ours = {key: value for key, value in SETTINGS.items() if spark.conf.get(key, None) is None}
    for key, value in ours.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in ours:
            spark.conf.unset(key)
