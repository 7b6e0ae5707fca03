"""Hand-made input tables. Only what a test cares about has to be given."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import SparkSession

from tillroll.sources.tables import GoldTables, SilverTables

CURRENT = date(9999, 12, 31)
FACT = (
    "fiscal_date date, transaction_number bigint, customer_hk bigint, location_hk bigint, item_hk bigint,"
    " register_hk int, ecomm_flag string, merch_sales decimal(18,2), merch_scan_margin decimal(18,2),"
    " unit_count bigint, item_count int"
)
# location_hk -> banner and type
STORES = [(1, "SOF", "ST"), (2, "BLF", "ST"), (3, "QF", "ST"), (4, "SOF", "WH"), (5, "UF", "CS")]
IN_STORE, ECOMM = "Non-Ecomm Sale", "Ecomm Sale"


def sale(day, txn=1, customer=10, store=1, item=1, register=1, flag=IN_STORE, sales="1.00", scan="0.50", units=1):
    money = [None if value is None else Decimal(value) for value in (sales, scan)]
    return (day, txn, customer, store, item, register, flag, *money, units, 1)


def gold(spark: SparkSession, sales, customers, registers=((1, "1001"), (2, "1099"), (3, "1097"))) -> GoldTables:
    """``customers`` are (customer_hk, card, household, card type, eff_to_dt) rows."""
    return GoldTables(
        spark.createDataFrame(list(sales), FACT),
        spark.createDataFrame(STORES, "location_hk bigint, current_banner_short_name string, location_type string"),
        spark.createDataFrame([(1, "Y"), (2, "N")], "item_hk bigint, current_financial_sale_flag string"),
        spark.createDataFrame(list(registers), "register_hk int, id string"),
        spark.createDataFrame(
            list(customers),
            "customer_hk bigint, card_number string, current_household_id string, current_card_type string,"
            " eff_to_dt date",
        ),
    )


def silver(spark: SparkSession, sales, customers) -> SilverTables:
    """``sales`` are (day, customer id, store, flag) rows, ``customers`` (customer id, card, eff_to_dt)."""
    rows = [(datetime(d.year, d.month, d.day, 13, 5), customer, store, flag, 1) for d, customer, store, flag in sales]
    return SilverTables(
        spark.createDataFrame(
            rows, "fiscal_date timestamp_ntz, customer_id bigint, store_number bigint, ecomm_flag string, item_id bigint"
        ),
        spark.createDataFrame(list(customers), "ldw_customer_id bigint, card_number string, eff_to_dt date"),
        spark.createDataFrame(
            [(1, "Y", CURRENT), (1, "N", date(2000, 1, 1)), (2, "N", CURRENT), (2, "Y", date(2000, 1, 1))],
            "id bigint, financial_sale_flag string, eff_to_dt date",
        ),
        spark.createDataFrame(
            [(store, banner, kind, CURRENT) for store, banner, kind in STORES],
            "id bigint, banner_short_name string, location_type string, eff_to_dt date",
        ),
    )
