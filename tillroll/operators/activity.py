"""Weekly activity of a key as bitmaps, and rolling-window flags read off them.

Weeks are numbered and cut into blocks of 32. A key's activity in one block is one row with one
``bigint`` per series, so facts collapse with ``bit_or`` before they are shuffled: a key brings at
most one row per block out of each input partition, however many sales it has. Looking back never
reaches past the previous block, so joining a block to its predecessor (``with_history``) gives
every week of the block its whole history inside one 64-bit value. The rows per week are generated
last, after all shuffles.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.calendar import week_end_of_number, week_number, week_number_of

BLOCK_WEEKS = 32
_BLOCK_BITS = 5
# Flags that are packed into one integer.
_WORD_FLAGS = 30


def weekly_bitmaps(events: DataFrame, key: str, event_date: str, series: Mapping[str, Column]) -> DataFrame:
    """One row per (key, block); bit ``w`` of a series is set when its condition held in week ``w``."""
    week = F.col("_week")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), week.bitwiseAND(BLOCK_WEEKS - 1))
    return (
        events.withColumn("_week", week_number_of(F.col(event_date)))
        .groupBy(key, F.shiftright(week, _BLOCK_BITS).alias("block"))
        .agg(*[F.bit_or(F.when(held, bit).otherwise(F.lit(0))).alias(name) for name, held in series.items()])
    )


def with_history(bitmaps: DataFrame, key: str, series: Sequence[str]) -> DataFrame:
    """Merge bitmaps per key and put the previous block into the lower 32 bits of each block."""
    to_next = F.explode(F.array(F.lit(0), F.lit(1))).alias("_to_next")
    offset = F.lit(BLOCK_WEEKS) - F.col("_to_next") * BLOCK_WEEKS
    return (
        bitmaps.select(key, "block", *series, to_next)
        .groupBy(key, (F.col("block") + F.col("_to_next")).alias("block"))
        .agg(*[F.bit_or(F.call_function("shiftleft", F.col(name), offset)).alias(name) for name in series])
    )


def merge_keys(histories: DataFrame, key: str, series: Sequence[str]) -> DataFrame:
    """Union the histories of all rows that share a (coarser) key."""
    return histories.groupBy(key, "block").agg(*[F.bit_or(name).alias(name) for name in series])


def flags_per_week(
    histories: DataFrame,
    key: str,
    presence: str,
    series: Sequence[str],
    windows: Mapping[str, tuple[int, int]],
    first_week: date,
    last_week: date,
) -> DataFrame:
    """One row per (key, week) that has ``presence`` within the longest window, with 0/1 flags.

    ``windows`` maps a name to its newest and oldest week, counted in weeks ago.
    """
    weeks, week_end, hits = _weeks(histories, key, presence, series, windows, first_week, last_week)
    return weeks.select(key, week_end, *[hit.cast("int").alias(name) for name, hit in hits.items()])


def packed_flags_per_week(
    histories: DataFrame,
    key: str,
    presence: str,
    series: Sequence[str],
    windows: Mapping[str, tuple[int, int]],
    first_week: date,
    last_week: date,
) -> DataFrame:
    """``flags_per_week`` with its flags as the bits of integers, for rows that are still to be moved or
    sorted; ``unpack_words`` makes the columns."""
    weeks, week_end, hits = _weeks(histories, key, presence, series, windows, first_week, last_week)
    words = [
        reduce(lambda a, b: a.bitwiseOR(b), [F.when(hits[name], F.lit(1 << i)).otherwise(F.lit(0)) for i, name in enumerate(names)]).alias(word)
        for word, names in _words(list(hits)).items()
    ]
    return weeks.select(key, week_end, *words)


def unpack_words(flags: Sequence[str]) -> list[Column]:
    """The 0/1 columns named by ``flags``, which are those of ``flags_per_week`` in its order."""
    return [column for word, names in _words(flags).items() for column in unpack_flags(word, names)]


def _words(flags: Sequence[str]) -> dict[str, Sequence[str]]:
    return {f"_flags_{at}": flags[at : at + _WORD_FLAGS] for at in range(0, len(flags), _WORD_FLAGS)}


def _weeks(
    histories: DataFrame,
    key: str,
    presence: str,
    series: Sequence[str],
    windows: Mapping[str, tuple[int, int]],
    first_week: date,
    last_week: date,
) -> tuple[DataFrame, Column, dict[str, Column]]:
    """The rows of ``flags_per_week``, the end of their week and the conditions of their flags."""
    lookback = max(oldest for _, oldest in windows.values())
    if lookback > BLOCK_WEEKS:
        raise ValueError(f"windows reach {lookback} weeks back; beyond {BLOCK_WEEKS}, use long_flags_per_week")

    slot = F.col("_slot")
    number = F.col("block") * BLOCK_WEEKS + slot
    shift = slot + (BLOCK_WEEKS - lookback)

    def hit(name: str, newest: int, oldest: int) -> Column:
        # After the shift the week itself is bit ``lookback`` and the oldest week is bit 0.
        mask = sum(1 << (lookback - ago) for ago in range(newest, oldest + 1))
        recent = F.call_function("shiftrightunsigned", F.col(name), shift)
        return recent.bitwiseAND(F.lit(mask).cast("bigint")) != 0

    slots = F.explode(F.array(*[F.lit(i) for i in range(BLOCK_WEEKS)])).alias("_slot")
    first, last = week_number(first_week), week_number(last_week)
    weeks = (
        histories.filter(F.col("block").between(first >> _BLOCK_BITS, last >> _BLOCK_BITS))
        .select(key, "block", presence, *series, slots)
        .filter(number.between(first, last) & hit(presence, 0, lookback))
    )
    hits = {
        f"{name}_{window}_flag": hit(name, newest, oldest) for name in series for window, (newest, oldest) in windows.items()
    }
    return weeks, week_end_of_number(number).alias("week_end_date"), hits


def with_long_history(bitmaps: DataFrame, key: str, series: Sequence[str], blocks_back: int) -> DataFrame:
    """Merge bitmaps per key; a series becomes an array of its words, the block's own and those of the
    ``blocks_back`` blocks before it, newest first. One shuffle, of a row per key, block and word."""
    age = F.explode(F.sequence(F.lit(0), F.lit(blocks_back))).alias("_age")

    def word(name: str, ago: int) -> Column:
        return F.bit_or(F.when(F.col("_age") == ago, F.col(name)).otherwise(F.lit(0)))

    return (
        bitmaps.select(key, "block", *series, age)
        .groupBy(key, (F.col("block") + F.col("_age")).alias("block"))
        .agg(*[F.array(*[word(name, ago) for ago in range(blocks_back + 1)]).alias(name) for name in series])
    )


def merge_long_keys(histories: DataFrame, key: str, series: Sequence[str], blocks_back: int) -> DataFrame:
    """Union the long histories of all rows that share a (coarser) key, word by word."""
    return histories.groupBy(key, "block").agg(
        *[F.array(*[F.bit_or(F.col(name)[ago]) for ago in range(blocks_back + 1)]).alias(name) for name in series]
    )


def blocks_for(windows: Mapping[str, tuple[int, int]]) -> int:
    """Former blocks that a week needs to look back over the longest window."""
    return -(-max(oldest for _, oldest in windows.values()) // BLOCK_WEEKS)


def long_flags_per_week(
    histories: DataFrame,
    key: str,
    presence: str,
    series: Sequence[str],
    windows: Mapping[str, tuple[int, int]],
    first_week: date,
    last_week: date,
) -> DataFrame:
    """``flags_per_week`` over windows of any length, from ``with_long_history``.

    Week ``slot`` of a block saw week ``ago`` at bit ``slot + 32 * word - ago`` of a word, so a window
    is a stretch of bits in each word, cut at the word's ends.
    """
    back = blocks_for(windows)
    slot = F.col("_slot")
    number = F.col("block") * BLOCK_WEEKS + slot

    def ones(bits: Column) -> Column:
        """The lowest ``bits`` bits, of 0 to 32."""
        held = F.least(F.greatest(bits, F.lit(0)), F.lit(BLOCK_WEEKS))
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), held) - 1

    def hit(name: str, newest: int, oldest: int) -> Column:
        found = []
        for word in range(back + 1):
            mask = ones(slot + (BLOCK_WEEKS * word - newest + 1)) - ones(slot + (BLOCK_WEEKS * word - oldest))
            found.append(F.col(name)[word].bitwiseAND(mask) != 0)
        return reduce(lambda a, b: a | b, found)

    slots = F.explode(F.array(*[F.lit(i) for i in range(BLOCK_WEEKS)])).alias("_slot")
    first, last = week_number(first_week), week_number(last_week)
    longest = max(oldest for _, oldest in windows.values())
    weeks = (
        histories.filter(F.col("block").between(first >> _BLOCK_BITS, last >> _BLOCK_BITS))
        .select(key, "block", presence, *series, slots)
        .filter(number.between(first, last) & hit(presence, 0, longest))
    )
    return weeks.select(
        key,
        week_end_of_number(number).alias("week_end_date"),
        *[
            hit(name, newest, oldest).cast("int").alias(f"{name}_{window}_flag")
            for name in series
            for window, (newest, oldest) in windows.items()
        ],
    )


def pack_flags(flags: Sequence[str]) -> Column:
    """0/1 columns as the bits of one integer, in the given order."""
    return reduce(lambda a, b: a + b, [F.when(F.col(name) == 1, 1 << i).otherwise(0) for i, name in enumerate(flags)])


def unpack_flags(packed: str, flags: Sequence[str]) -> list[Column]:
    return [(F.col(packed).bitwiseAND(1 << i) != 0).cast("int").alias(name) for i, name in enumerate(flags)]
