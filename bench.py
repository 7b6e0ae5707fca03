"""Time the headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR and print one JSON line.

Each query is planned and run to completion into a sink that drops the rows. ``queries`` holds the
better of two runs after one warm-up, ``first_run`` the warm-up itself; ``dq_report``, which writes and
checks all seven tables, runs once. With ``--compare`` the
plain semi-join formulation of the activity flags is timed as well.
"""

from __future__ import annotations

import json
import os
import sys
import time
from datetime import datetime
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

from tillroll.catalogue import AS_OF, QUERIES  # noqa: E402
from tillroll.session import local_session  # noqa: E402

HEADLINE = [
    "pos_daily_agg_card",
    "pos_daily_agg_hhn",
    "card_shop_dates",
    "household_shop_dates",
    "card_transactions",
    "household_transactions",
    "household_transactions_from_sales",
    "household_transactions_from_cards",
    "household_type",
    "range_join_weeks",
    "semi_join_flag",
    "dq_flag_implication",
    "dq_distinct_count_recon",
    "dq_row_mismatch",
    "dq_report",
]
RUN_ONCE = {"dq_report"}


def run(build, spark, sf_dir) -> float:
    start = time.perf_counter()
    build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def semi_joins(spark, sf_dir):
    from tests.semi_join_formulation import card_transactions
    from tillroll.sources import star

    return card_transactions(star.gold(spark, sf_dir), AS_OF)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "tillroll-bench")
    spark.sparkContext.setLogLevel("ERROR")
    builds = {name: QUERIES[name] for name in HEADLINE}
    if "--compare" in sys.argv:
        builds["card_transactions_by_semi_joins"] = semi_joins
    first, best = {}, {}
    for name, build in builds.items():
        first[name] = run(build, spark, sf_dir)
        best[name] = first[name] if name in RUN_ONCE else min(run(build, spark, sf_dir) for _ in range(2))
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(best[name] for name in HEADLINE), 3),
                "unit": "sec",
                "queries": best,
                "first_run": first,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": cpus,
                "finished": datetime.now().isoformat(timespec="seconds"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
