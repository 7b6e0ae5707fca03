"""Batch entry point: refresh tables, check them, publish them.

    spark-submit --py-files ... tillroll/jobs.py --gold <folder> --silver <folder> --out <folder>
        [--as-of 2001-08-01T06:00:00] [--tables card_transactions ...] [--report <folder>] [--publish]
        [--steps refresh check] [--format parquet] [--settings '{"location_types": ["ST"]}']
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Mapping, Sequence
from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import SparkSession

from tillroll.domain import Settings
from tillroll.operators import quality
from tillroll.plans import checks
from tillroll.plans.refresh import BUILDERS, Store
from tillroll.sources import sinks
from tillroll.sources.tables import read_gold, read_silver

# The database each table is published in.
DATABASES = {name: "sales" if name.startswith("pos_daily") else "customer" for name in BUILDERS}


def pacific_now() -> datetime:
    """Run time on the company's clock, to the second and without a zone."""
    return datetime.now(ZoneInfo("America/Los_Angeles")).replace(microsecond=0, tzinfo=None)


Counts = Mapping[str, Mapping[str, int]]


def refresh(store: Store, names: Sequence[str], publish: bool = False) -> Counts:
    """Rebuild the named tables and, if asked, (re-)create the catalog entries of those that are not kept
    as versions. Returns what was counted on the way."""
    counts = store.refresh_counting(names)
    for name in counts:
        if publish and name not in store.databases:
            sinks.publish(store.spark, DATABASES[name], name, store.path(name), store.fmt)
    return counts


def check(store: Store, names: Sequence[str], report_base: str | None = None, counts: Counts | None = None) -> None:
    """Run the checks of the named stored tables, log them and fail on a failed gating check. ``counts`` are
    those of the refresh that has just stored the tables."""
    tables = {name: store.table(name) for name in names}
    report = checks.quality_report(tables, store.table, store.gold, store.silver, store.as_of, store.settings, counts, store.deviating_files)
    with sinks.scratch(store.spark) as folder:
        # A handful of rows, stored once so that logging and judging them runs the checks only once.
        results = sinks.stored(report, folder)
        if report_base:
            sinks.append_report(results, report_base, store.as_of)
        quality.enforce(results, advisory=checks.ADVISORY_CHECKS)


STEPS = ("refresh", "check")


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--gold", required=True, help="folder of the gold input tables")
    parser.add_argument("--silver", required=True, help="folder of the silver input tables")
    parser.add_argument("--out", required=True, help="folder of the tables to refresh")
    parser.add_argument("--as-of", type=datetime.fromisoformat, help="run time; default: now, Pacific time")
    parser.add_argument("--tables", nargs="+", choices=list(BUILDERS), default=list(BUILDERS), help="default: all")
    parser.add_argument("--steps", nargs="+", choices=STEPS, default=STEPS, help="default: both")
    parser.add_argument("--report", help="folder for the check reports")
    parser.add_argument("--publish", action="store_true", help="tables are catalog tables: plain formats in versions that a refresh switches between, others by their path")
    parser.add_argument("--format", default="parquet", help="format of input and output tables")
    parser.add_argument("--settings", type=lambda text: Settings(**json.loads(text)), default=Settings(), help="JSON object of settings that differ from the defaults")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("tillroll").getOrCreate()
    as_of = args.as_of or pacific_now()
    gold, silver = read_gold(spark, args.gold, args.format), read_silver(spark, args.silver, args.format)
    databases = DATABASES if args.publish and args.format in sinks.PLAIN_FORMATS else {}
    store = Store(gold, silver, as_of, args.out, fmt=args.format, settings=args.settings, databases=databases)
    counts = refresh(store, args.tables, args.publish) if "refresh" in args.steps else None
    if "check" in args.steps:
        check(store, args.tables, args.report, counts)


if __name__ == "__main__":
    main()
