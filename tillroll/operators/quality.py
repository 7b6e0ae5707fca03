"""Data-quality checks. Each returns a DataFrame; nothing is collected here."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

RESULT_COLUMNS = ["table_name", "test_result", "test_case_name", "execution_date"]


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("cnt")).filter(F.col("cnt") > 1)


def repeated_days(df: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """Empty if and only if ``duplicate_keys`` of ``keys`` and the date ``day`` is: the keys, with a stretch of 64
    weeks and a day of the week, that have more rows than days. A row and bitmap stand for a key's weeks in a stretch,
    formed before the shuffle, so that weekly rows are not moved one by one."""
    number = F.unix_date(day)
    weekday = F.pmod(number, F.lit(7))
    week = ((number - weekday) / 7).cast("bigint")
    held = F.call_function("shiftleft", F.lit(1).cast("bigint"), week.bitwiseAND(63).cast("int"))
    days = F.coalesce(F.bit_count(F.bit_or(held)), F.lit(1))
    grouped = df.groupBy(*keys, weekday.alias("_weekday"), F.shiftright(week, 6).alias("_stretch"))
    return grouped.agg(F.count("*").alias("cnt"), days.alias("_days")).filter(F.col("cnt") > F.col("_days"))


def any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(name).isNull() for name in columns])


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column with its number of NULLs, from a single pass."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    return counts.unpivot([], list(columns), "column_name", "null_count")


def broken_implication(pairs: Mapping[str, str]) -> Column:
    """True where a flag is 1 while the flag it implies has another value."""
    return reduce(lambda a, b: a | b, [(F.col(p) == 1) & (F.col(p) != F.col(c)) for p, c in pairs.items()])


def implication_counts(df: DataFrame, pairs: Mapping[str, str]) -> DataFrame:
    """Per implied pair: rows where the premise holds and rows that break the implication."""
    both = df.agg(
        *[
            F.struct(
                F.count_if(F.col(premise) == 1).alias("premise_rows"),
                F.count_if(broken_implication({premise: conclusion})).alias("broken_rows"),
            ).alias(premise)
            for premise, conclusion in pairs.items()
        ]
    )
    return both.unpivot([], list(pairs), "premise", "_counts").select("premise", "_counts.*")


def compare_sides(source: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows over ``columns`` with ``in_source`` / ``in_target`` marks (0 or 1).

    NULLs compare equal, as in EXCEPT. Both sides are reduced before the one shuffle, so a row that
    is repeated very often costs no more than any other.
    """
    marked = source.select(*columns, F.lit(1).alias("_s"), F.lit(0).alias("_t")).unionByName(
        target.select(*columns, F.lit(0).alias("_s"), F.lit(1).alias("_t"))
    )
    return marked.groupBy(*columns).agg(F.max("_s").alias("in_source"), F.max("_t").alias("in_target"))


def missing_in_target(source: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _only(compare_sides(source, target, columns), "in_source", "in_target")


def _only(sides: DataFrame, present: str, absent: str) -> DataFrame:
    return sides.filter((F.col(present) == 1) & (F.col(absent) == 0)).drop(present, absent)


def reconcile(source: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: distinct rows on each side and those found on one side only."""
    return compare_sides(source, target, columns).agg(
        F.count_if(F.col("in_source") == 1).alias("source_rows"),
        F.count_if(F.col("in_target") == 1).alias("target_rows"),
        F.count_if(F.col("in_target") == 0).alias("only_in_source"),
        F.count_if(F.col("in_source") == 0).alias("only_in_target"),
    )


def passed_if_empty(name: str, violations: DataFrame) -> DataFrame:
    return passed_if(name, violations.agg(F.count("*").alias("_found")), F.col("_found") == 0)


def passed_if(name: str, counts: DataFrame, condition: Column) -> DataFrame:
    """Verdict from a one-row DataFrame."""
    return counts.select(F.lit(name).alias("test_case_name"), _verdict(condition))


def row_checks(df: DataFrame, violations: Mapping[str, Column]) -> DataFrame:
    """Verdicts of any number of row-level checks from a single pass over the table."""
    counts = df.agg(*[F.count_if(broken).alias(name) for name, broken in violations.items()])
    found = counts.unpivot([], list(violations), "test_case_name", "_found")
    return found.select("test_case_name", _verdict(F.col("_found") == 0))


ROWS = "rows"


def counting(df: DataFrame, violations: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` and an observation of its rows and violations, counted on the way by the next action over it.

    To be put last before a write: counts of the stage that ends an action are taken once for each task,
    however often a task is repeated.
    """
    observation = Observation(f"checks-{uuid.uuid4().hex}")
    counts = [F.count_if(broken).alias(name) for name, broken in violations.items()]
    return df.observe(observation, F.count(F.lit(1)).alias(ROWS), *counts), observation


def known(spark: SparkSession, name: str, passed: bool) -> DataFrame:
    """Verdict of a check that needs no data any more."""
    return spark.sql("SELECT :name AS test_case_name, :found AS test_result", {"name": name, "found": "Pass" if passed else "Fail"})


def column_check(name: str, df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Verdict on names and order of the columns; decided from the schema, no data is read."""
    return known(df.sparkSession, name, df.columns == list(expected))


def _verdict(condition: Column) -> Column:
    return F.when(condition, "Pass").otherwise("Fail").alias("test_result")


def report(verdicts: Mapping[str, Sequence[DataFrame]], executed: datetime) -> DataFrame:
    """Verdicts of all tables, by table name, as one DataFrame with a row per check."""
    rows = [
        verdict.withColumn("table_name", F.lit(table_name))
        for table_name, frames in verdicts.items()
        for verdict in frames
    ]
    stamp = F.lit(executed.strftime("%Y-%m-%d %H:%M:%S"))
    return reduce(DataFrame.unionByName, rows).withColumn("execution_date", stamp).select(*RESULT_COLUMNS)


class QualityGateError(RuntimeError):
    """At least one gating check failed."""


def enforce(report_rows: DataFrame, advisory: Sequence[str] = ()) -> None:
    """Raise when a check failed, except for the named advisory ones. Reads one row per check."""
    failed = report_rows.filter((F.col("test_result") != "Pass") & ~F.col("test_case_name").isin(list(advisory)))
    names = [f"{row.table_name}: {row.test_case_name}" for row in failed.collect()]
    if names:
        raise QualityGateError("Failed checks: " + ", ".join(sorted(names)))
