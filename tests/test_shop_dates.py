from __future__ import annotations

from datetime import date, datetime

from tests.small_tables import CURRENT, ECOMM, IN_STORE, gold, silver
from tillroll.domain import TABLE_COLUMNS, shop_date_columns
from tillroll.plans.shop_dates import card_shop_dates, household_shop_dates

AS_OF = datetime(2001, 8, 1)
D1, D2, D3 = date(1990, 5, 1), date(1999, 5, 1), date(2001, 7, 28)


def _by_card(spark, sales, customers):
    return {r.card_number: r for r in card_shop_dates(silver(spark, sales, customers), AS_OF).collect()}


def test_card_without_sales_has_a_row_of_nulls(spark):
    row = _by_card(spark, [], [(1, "5", CURRENT)])["5"]
    assert [row[name] for name in shop_date_columns()] == [None] * 42


def test_dates_per_scope_and_channel(spark):
    sales = [(D2, 1, 1, IN_STORE), (D1, 1, 5, IN_STORE), (D3, 1, 3, ECOMM), (date(2001, 7, 29), 1, 1, IN_STORE),
             (D1, 1, 4, IN_STORE), (date(1980, 1, 1), 1, 1, None)]
    row = _by_card(spark, sales, [(1, "5", CURRENT)])["5"]
    found = {name: row[name] for name in shop_date_columns() if row[name] is not None}
    assert found == {
        "sof_instore_first_shop_date": D1, "sof_instore_last_shop_date": D2,
        "sof_only_instore_first_shop_date": D2, "sof_only_instore_last_shop_date": D2,
        "uf_only_instore_first_shop_date": D1, "uf_only_instore_last_shop_date": D1,
        "qf_only_ecom_first_shop_date": D3, "qf_only_ecom_last_shop_date": D3,
        "pfg_instore_first_shop_date": D1, "pfg_instore_last_shop_date": D2,
        "pfg_ecom_first_shop_date": D3, "pfg_ecom_last_shop_date": D3,
        "pfg_overall_first_shop_date": D1, "pfg_overall_last_shop_date": D3,
    }


def test_only_ecom_sales_still_give_overall_dates(spark):
    row = _by_card(spark, [(D2, 1, 2, ECOMM)], [(1, "5", CURRENT)])["5"]
    assert (row.pfg_overall_first_shop_date, row.pfg_overall_last_shop_date) == (D2, D2)
    assert row.pfg_instore_first_shop_date is None


def test_latest_version_of_a_card_decides_whose_sales_count(spark):
    customers = [(1, "5", date(2000, 1, 1)), (2, "5", CURRENT), (2, "6", CURRENT), (3, "0", CURRENT), (4, "7", None)]
    rows = _by_card(spark, [(D1, 1, 1, IN_STORE), (D2, 2, 1, IN_STORE), (D1, 3, 1, IN_STORE)], customers)
    assert sorted(rows) == ["5", "6", "7"]
    assert rows["5"].pfg_instore_first_shop_date == rows["6"].pfg_instore_first_shop_date == D2


def test_card_counts_in_every_household_it_was_in(spark):
    tables = silver(spark, [(D1, 1, 1, IN_STORE), (D3, 2, 1, IN_STORE)], [(1, "5", CURRENT), (2, "6", CURRENT)])
    customers = [(1, "5", "a", None, date(2000, 1, 1)), (1, "5", "b", None, CURRENT), (2, "6", "b", None, CURRENT),
                 (3, "8", "c", None, CURRENT), (9, "0", "z", None, CURRENT)]
    card_dates = card_shop_dates(tables, AS_OF)
    result = household_shop_dates(card_dates, gold(spark, [], customers).customer_dim, AS_OF)
    rows = {r.hhn: (r.pfg_overall_first_shop_date, r.pfg_overall_last_shop_date) for r in result.collect()}
    assert rows == {"a": (D1, D1), "b": (D1, D3)}
    assert card_dates.columns == TABLE_COLUMNS["card_shop_dates"]
    assert result.columns == TABLE_COLUMNS["household_shop_dates"]
