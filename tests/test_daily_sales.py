from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from tests.small_tables import CURRENT, ECOMM, IN_STORE, gold, sale
from tillroll.domain import TABLE_COLUMNS
from tillroll.plans.daily_sales import pos_daily_agg_card, pos_daily_agg_hhn

AS_OF = datetime(2001, 8, 1)
DAY = date(2001, 7, 20)
CUSTOMERS = [(10, "5", "h1", "Customer Card", CURRENT), (11, "5", "h2", "Customer Card", date(2000, 1, 1)),
             (99, "0", None, None, CURRENT)]


def _card(spark, sales):
    return pos_daily_agg_card(gold(spark, sales, CUSTOMERS), AS_OF)


def test_channels(spark):
    rows = _card(
        spark,
        [
            sale(DAY, 1, register=2, flag=IN_STORE),
            sale(DAY, 2, register=2, flag=ECOMM),
            sale(DAY, 3, register=3, flag=ECOMM),
            sale(DAY, 4, register=1, flag=ECOMM),
            sale(DAY, 5, register=77, flag=ECOMM),
            sale(DAY, 6, register=2, flag=None),
        ],
    ).collect()
    assert {r.channel: r.transaction_count for r in rows} == {
        "In Store": 1, "Delivery": 1, "Pickup": 1, "Adjustment": 3,
    }


def test_only_bounds_banners_and_financial_items_count(spark):
    kept = [sale(date(1998, 12, 27), 1), sale(date(2001, 7, 28), 2), sale(DAY, 3, store=4), sale(DAY, 4, store=5)]
    dropped = [
        sale(date(1998, 12, 26), 5), sale(date(2001, 7, 29), 6), sale(DAY, 7, store=2), sale(DAY, 8, store=3),
        sale(DAY, 9, item=2), sale(DAY, 10, store=123),
    ]
    df = _card(spark, kept + dropped)
    assert sum(r.transaction_count for r in df.collect()) == len(kept)
    assert df.columns == TABLE_COLUMNS["pos_daily_agg_card"]


def test_missing_scan_is_zero_but_missing_sales_stay_missing(spark):
    row = _card(spark, [sale(DAY, 1, sales=None, scan=None, units=None)]).first()
    assert (row["sales"], row["scan"], row["units"], row["items"]) == (None, Decimal(0), None, 1)


def test_anonymous_card_is_kept(spark):
    assert [r.customer_hk for r in _card(spark, [sale(DAY, 1, customer=99)]).collect()] == [99]


def test_transaction_in_two_channels_counts_once_in_each_and_twice_per_household(spark):
    tables = gold(spark, [sale(DAY, 1), sale(DAY, 1), sale(DAY, 1, register=2, flag=ECOMM)], CUSTOMERS)
    card = pos_daily_agg_card(tables, AS_OF)
    assert sorted((r.channel, r.transaction_count, r["items"]) for r in card.collect()) == [
        ("Delivery", 1, 1), ("In Store", 1, 2),
    ]
    household = pos_daily_agg_hhn(card, tables.customer_dim, AS_OF)
    assert sum(r.transaction_count for r in household.collect()) == 2
    assert household.columns == TABLE_COLUMNS["pos_daily_agg_hhn"]


def test_household_sums_go_over_customer_versions(spark):
    customers = [(10, "5", "h1", None, CURRENT), (11, "6", "h1", None, CURRENT), (12, "7", None, None, CURRENT)]
    tables = gold(spark, [sale(DAY, 1, 10), sale(DAY, 1, 11), sale(DAY, 2, 12), sale(DAY, 3, 13)], customers)
    household = pos_daily_agg_hhn(pos_daily_agg_card(tables, AS_OF), tables.customer_dim, AS_OF)
    assert {r.hhn: (r.transaction_count, r["sales"]) for r in household.collect()} == {
        "h1": (2, Decimal("2.00")), None: (1, Decimal("1.00")),
    }
