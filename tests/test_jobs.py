from __future__ import annotations

import json
from datetime import datetime

import pytest

from tillroll import jobs
from tillroll.domain import TABLE_COLUMNS, Settings
from tillroll.operators.quality import QualityGateError
from tillroll.plans import checks
from tillroll.plans.activity import household_transactions_from_sales
from tillroll.plans.refresh import BUILDERS, Store
from tillroll.sources import sinks, star

SF = "/root/testdata/sf0.001"
AS_OF = datetime(2001, 8, 1)


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("inputs")
    for kind, tables in (("gold", star.gold(spark, SF)), ("silver", star.silver(spark, SF))):
        for name, df in vars(tables).items():
            sinks.full_refresh(df, f"{base}/{kind}/{name}")
    return str(base)


def _run(inputs, out, *extra):
    jobs.main(["--gold", f"{inputs}/gold", "--silver", f"{inputs}/silver", "--out", out, "--as-of", "2001-08-01", *extra])


def test_tables_are_refreshed_one_by_one_checked_and_published(spark, inputs, tmp_path):
    out, report = str(tmp_path / "out"), str(tmp_path / "report")
    _run(inputs, out, "--tables", "card_transactions", "--steps", "refresh")
    _run(inputs, out, "--tables", "card_transactions", "--steps", "check", "--report", report)
    _run(inputs, out, "--tables", "household_transactions", "--report", report, "--publish")
    published = spark.table("customer.household_transactions")
    assert set(published.columns) == set(TABLE_COLUMNS["household_transactions"])
    log = spark.read.option("header", True).csv(sinks.report_path(report, AS_OF)).collect()
    assert {r.table_name for r in log} == {"card_transactions", "household_transactions"}
    assert {r.test_result for r in log} == {"Pass"}
    spark.sql("DROP DATABASE customer CASCADE")


def test_failed_check_fails_the_job_after_the_report_is_written(spark, inputs, tmp_path):
    out, report = str(tmp_path / "out"), str(tmp_path / "report")
    with pytest.raises(QualityGateError, match="Gold_Household_Type"):
        _run(inputs, out, "--tables", "household_type", "--report", report)
    log = spark.read.option("header", True).csv(sinks.report_path(report, AS_OF))
    assert log.filter("test_result = 'Fail'").count() == 1


def test_damaged_table_is_found_by_checking_alone(spark, inputs, tmp_path):
    out = str(tmp_path / "out")
    _run(inputs, out, "--tables", "card_shop_dates", "--steps", "refresh")
    sound = spark.read.parquet(f"{out}/card_shop_dates")
    damaged = sound.filter("card_number <> '7'").withColumn("extra", sound["dl_load_dt"])
    sinks.full_refresh(damaged, f"{tmp_path}/bad/card_shop_dates")
    _run(inputs, out, "--tables", "card_shop_dates", "--steps", "check")
    with pytest.raises(QualityGateError, match="Column Def Check.*Verifying"):
        _run(inputs, f"{tmp_path}/bad", "--tables", "card_shop_dates", "--steps", "check")


def test_banners_scopes_and_location_types_are_the_callers(spark, inputs, tmp_path):
    out, report = str(tmp_path / "out"), str(tmp_path / "report")
    own = {
        "daily_banners": ["BLF"],
        "banner_groups": {"qf": ["QF"], "both": ["SOF", "BLF"], "uf": ["UF"]},
        "location_types": ["ST"],
        "shop_scopes": {"quick": ["QF"]},
    }
    tables = ["pos_daily_agg_card", "pos_daily_agg_hhn", "card_shop_dates", "household_shop_dates", "card_transactions", "household_transactions"]
    _run(inputs, out, "--settings", json.dumps(own), "--report", report, "--tables", *tables)
    log = spark.read.option("header", True).csv(sinks.report_path(report, AS_OF)).collect()
    assert {r.table_name for r in log} == {checks.REPORT_NAMES[name] for name in tables}
    flags = spark.read.parquet(f"{out}/household_transactions")
    assert [c for c in flags.columns if c.endswith("4wk_flag")] == [f"{g}_{c}_current_4wk_flag" for g in own["banner_groups"] for c in ("instore", "ecomm")]
    dates = spark.read.parquet(f"{out}/household_shop_dates")
    assert dates.columns[1:9] == [f"{s}_{c}_{e}_shop_date" for s in ("quick", "pfg") for c in ("instore", "ecom") for e in ("first", "last")]
    # The weeks of the narrower choice are found by the plan from sales, and by the banners of the stores.
    settings = Settings(**own)
    gold = star.gold(spark, SF)
    again = household_transactions_from_sales(gold, AS_OF, groups=settings.banner_groups, location_types=["ST"])
    assert flags.select(*again.columns).exceptAll(again).isEmpty() and again.count() == flags.count() > 0
    stores = gold.location_dim.filter("current_banner_short_name = 'BLF'")
    daily = spark.read.parquet(f"{out}/pos_daily_agg_card")
    assert daily.count() == daily.join(stores, "location_hk").count() > 0


def test_unknown_table_is_refused(spark, tmp_path):
    store = Store(star.gold(spark, SF), star.silver(spark, SF), AS_OF, str(tmp_path))
    with pytest.raises(ValueError, match="receipts"):
        store.refresh(["receipts"])


def test_every_table_has_a_builder_and_a_database():
    assert set(BUILDERS) == set(TABLE_COLUMNS) == set(jobs.DATABASES)


def test_pacific_now_has_no_zone_and_whole_seconds():
    now = jobs.pacific_now()
    assert now.tzinfo is None and now.microsecond == 0
