"""Retail tables derived from the order-and-lineitem test tables (mapping: FIXTURES.md)."""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.domain import ECOMM_SALE, IN_STORE_SALE
from tillroll.sources.sinks import stored
from tillroll.sources.tables import GoldTables, SilverTables, read_table

CURRENT = date(9999, 12, 31)

# Declared, so that opening a table starts no job to look at file footers.
SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}
_BANNERS = ["SOF", "UF", "PSF", "BLF", "NM", "MFF", "QF", "OTH", "SOF"]
_TYPES = ["ST", "CS", "LS", "WH", "ST"]


class RawTables:
    """The Parquet tables of one scale-factor folder, opened on demand.

    ``folder`` is where the joined order lines are stored when they are first asked for, so that the join
    is made once however often sales are read; without it each reader makes the join.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, folder: str | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.folder = folder

    @cached_property
    def order_lines(self) -> DataFrame:
        """What sales are made of. All that is worked out of a line or an order is so below the join: with nothing but
        names above it, Spark moves semi joins of sales below the join too."""
        price = F.col("l_extendedprice").cast("decimal(18,2)")
        tax = F.col("l_tax").cast("decimal(4,2)")
        lines = self.lineitem.select(
            "l_orderkey",
            "l_partkey",
            "l_suppkey",
            "l_linenumber",
            _ecomm_flag().alias("ecomm_flag"),
            (price * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).alias("merch_sales"),
            F.when(F.col("l_tax") > 0, price * tax).alias("merch_scan_margin"),
            F.col("l_quantity").cast("bigint").alias("unit_count"),
            F.lit(1).alias("item_count"),
        )
        orders = self.orders.select("o_orderkey", "o_custkey", "o_orderdate", F.col("o_orderdate").cast("date").alias("order_day"))
        joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
        if self.folder is None:
            return joined
        return stored(joined.drop("item_count"), f"{self.folder}/order_lines").withColumn("item_count", F.lit(1))

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        return read_table(self.spark, f"{self.sf_dir}/{name}.parquet", SCHEMAS[name])


def _pick(index: Column, values: list[str]) -> Column:
    """The value at a zero-based position."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _ecomm_flag() -> Column:
    return (
        F.when(F.col("l_returnflag") == "A", IN_STORE_SALE)
        .when(F.col("l_returnflag") == "N", ECOMM_SALE)
        .when(F.col("l_linestatus") == "F", IN_STORE_SALE)
    )


def _location_columns() -> list[Column]:
    return [
        _pick(F.col("s_suppkey") % 9, _BANNERS).alias("banner"),
        _pick(F.col("s_nationkey") % 5, _TYPES).alias("location_type"),
    ]


def retail_sale_fact(raw: RawTables) -> DataFrame:
    return raw.order_lines.select(
        F.col("order_day").alias("fiscal_date"),
        F.col("l_orderkey").alias("transaction_number"),
        F.col("o_custkey").alias("customer_hk"),
        F.col("l_suppkey").alias("location_hk"),
        F.col("l_partkey").alias("item_hk"),
        F.col("l_linenumber").alias("register_hk"),
        "ecomm_flag",
        "merch_sales",
        "merch_scan_margin",
        "unit_count",
        "item_count",
    )


def location_dim(raw: RawTables) -> DataFrame:
    return raw.supplier.select(F.col("s_suppkey").alias("location_hk"), *_location_columns()).withColumnRenamed(
        "banner", "current_banner_short_name"
    )


def item_dim(raw: RawTables) -> DataFrame:
    return raw.part.select(
        F.col("p_partkey").alias("item_hk"),
        F.when(F.col("p_type") == "PROMO", "N").otherwise("Y").alias("current_financial_sale_flag"),
    )


def register_dim(raw: RawTables) -> DataFrame:
    """Six registers; the seventh line number has none on purpose."""
    return raw.spark.sql(
        "SELECT * FROM VALUES (1, '1001'), (2, '1097'), (3, '1099'), (4, '2001'), (5, '2097'), (6, '2099')"
        " AS t(register_hk, id)"
    )


def customer_dim(raw: RawTables) -> DataFrame:
    """Two versions per card; some cards change household, some have no card type."""
    hk, card = F.col("c_custkey"), F.col("card")
    household = (
        F.when(card % 4 == 3, card - 1).when((card % 10 == 0) & (hk % 2 == 0), card + 1).otherwise(card)
    )
    segment = F.col("c_mktsegment")
    card_type = (
        F.when(hk % 97 == 0, F.lit(None))
        .when(hk % 17 == 0, "Training Cards")
        .when(segment == "HOUSEHOLD", "Customer Card")
        .when(segment == "FURNITURE", "VMore Cards")
        .when(segment == "MACHINERY", "Community Cards")
        .when(segment == "BUILDING", "Manager Cards")
        .otherwise("Unknown")
    )
    return raw.customer.withColumn("card", F.shiftright(hk, 1)).select(
        hk.alias("customer_hk"),
        card.cast("string").alias("card_number"),
        household.cast("string").alias("current_household_id"),
        card_type.alias("current_card_type"),
        F.when(hk % 2 == 1, F.lit(CURRENT)).otherwise(F.lit(date(2000, 1, 1))).alias("eff_to_dt"),
    )


def gold(spark: SparkSession, sf_dir: str) -> GoldTables:
    return gold_of(RawTables(spark, sf_dir))


def gold_of(raw: RawTables) -> GoldTables:
    return GoldTables(retail_sale_fact(raw), location_dim(raw), item_dim(raw), register_dim(raw), customer_dim(raw))


def silver(spark: SparkSession, sf_dir: str) -> SilverTables:
    return silver_of(RawTables(spark, sf_dir))


def silver_of(raw: RawTables) -> SilverTables:
    sales = raw.order_lines.select(
        F.col("o_orderdate").alias("fiscal_date"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_suppkey").alias("store_number"),
        F.col("l_partkey").alias("item_id"),
        "ecomm_flag",
    )
    customers = customer_dim(raw).select(F.col("customer_hk").alias("ldw_customer_id"), "card_number", "eff_to_dt")

    promo = F.col("p_type") == "PROMO"
    item_id = F.col("p_partkey").alias("id")
    flag = "financial_sale_flag"
    items = raw.part.select(
        item_id, F.when(promo, "Y").otherwise("N").alias(flag), F.lit(date(2000, 6, 30)).alias("eff_to_dt")
    ).unionByName(
        raw.part.select(item_id, F.when(promo, "N").otherwise("Y").alias(flag), F.lit(CURRENT).alias("eff_to_dt"))
    )

    store_id = F.col("s_suppkey").alias("id")
    former = raw.supplier.select(
        store_id,
        F.lit("QF").alias("banner_short_name"),
        F.lit("WH").alias("location_type"),
        F.lit(date(1999, 12, 31)).alias("eff_to_dt"),
    )
    present = raw.supplier.select(store_id, *_location_columns(), F.lit(CURRENT).alias("eff_to_dt"))
    locations = former.unionByName(present.withColumnRenamed("banner", "banner_short_name"))
    return SilverTables(sales, customers, items, locations)
