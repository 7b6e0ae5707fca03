"""SQL twins of the registered queries, for DuckDB over the raw tables.

Written from the table definitions, not from the Spark code: bounds are looked up in a calendar
table, activity flags come from joining every card week to its sales, and so on.
"""

from __future__ import annotations

RUN_DATE = "DATE '2001-08-01'"
STAMP = "TIMESTAMP '2001-08-01 00:00:00'"


def _saturday_before(day: str) -> str:
    return f"({day} - CAST(dayofweek({day}) + 1 AS INTEGER))"


def _sunday_from(day: str) -> str:
    return f"({day} - CAST(dayofweek({day}) AS INTEGER))"


def _week_end(day: str) -> str:
    return f"({day} + CAST(6 - dayofweek({day}) AS INTEGER))"


def _month_back(day: str) -> str:
    return f"CAST(date_trunc('month', {day}) - INTERVAL 31 MONTH AS DATE)"


# Common table expressions in dependency order; a query names the ones it ends in.
CTES: dict[str, str] = {}

CTES["retail_sale_fact"] = """
SELECT CAST(o_orderdate AS DATE) AS fiscal_date, l_orderkey AS transaction_number, o_custkey AS customer_hk,
       l_suppkey AS location_hk, l_partkey AS item_hk, l_linenumber AS register_hk,
       CASE WHEN l_returnflag = 'A' THEN 'Non-Ecomm Sale' WHEN l_returnflag = 'N' THEN 'Ecomm Sale'
            WHEN l_linestatus = 'F' THEN 'Non-Ecomm Sale' END AS ecomm_flag,
       CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS merch_sales,
       CASE WHEN l_tax > 0 THEN CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) END
           AS merch_scan_margin,
       CAST(l_quantity AS BIGINT) AS unit_count, 1 AS item_count
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

CTES["register_dim"] = """
SELECT * FROM (VALUES (1,'1001'),(2,'1097'),(3,'1099'),(4,'2001'),(5,'2097'),(6,'2099')) AS t(register_hk, id)"""

_BANNER = """CASE s_suppkey % 9 WHEN 0 THEN 'SOF' WHEN 1 THEN 'UF' WHEN 2 THEN 'PSF' WHEN 3 THEN 'BLF'
            WHEN 4 THEN 'NM' WHEN 5 THEN 'MFF' WHEN 6 THEN 'QF' WHEN 7 THEN 'OTH' ELSE 'SOF' END"""
_TYPE = "CASE s_nationkey % 5 WHEN 0 THEN 'ST' WHEN 1 THEN 'CS' WHEN 2 THEN 'LS' WHEN 3 THEN 'WH' ELSE 'ST' END"

CTES["location_dim"] = f"""
SELECT s_suppkey AS location_hk, {_BANNER} AS current_banner_short_name, {_TYPE} AS location_type FROM supplier"""

CTES["item_dim"] = """
SELECT p_partkey AS item_hk, CASE WHEN p_type = 'PROMO' THEN 'N' ELSE 'Y' END AS current_financial_sale_flag
FROM part"""

CTES["customer_dim"] = """
SELECT c_custkey AS customer_hk, CAST(k AS VARCHAR(20)) AS card_number,
       CAST(CASE WHEN k % 4 = 3 THEN k - 1 WHEN k % 10 = 0 AND c_custkey % 2 = 0 THEN k + 1 ELSE k END
            AS VARCHAR(20)) AS current_household_id,
       CASE WHEN c_custkey % 97 = 0 THEN NULL WHEN c_custkey % 17 = 0 THEN 'Training Cards'
            WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Customer Card' WHEN c_mktsegment = 'FURNITURE' THEN 'VMore Cards'
            WHEN c_mktsegment = 'MACHINERY' THEN 'Community Cards' WHEN c_mktsegment = 'BUILDING' THEN 'Manager Cards'
            ELSE 'Unknown' END AS current_card_type,
       CASE WHEN c_custkey % 2 = 1 THEN DATE '9999-12-31' ELSE DATE '2000-01-01' END AS eff_to_dt
FROM (SELECT c_custkey, c_mktsegment, CAST(FLOOR(c_custkey / 2) AS BIGINT) AS k FROM customer) x"""

CTES["date_dim"] = """
SELECT date, CAST(date + CAST(6 - dayofweek(date) AS INTEGER) AS DATE) AS week_end_date
FROM (SELECT CAST(unnest(generate_series(DATE '1994-01-02', DATE '2002-12-28', INTERVAL 1 DAY)) AS DATE) AS date) x"""

CTES["silver_retail_sale"] = """
SELECT o_orderdate AS fiscal_date, o_custkey AS customer_id, l_suppkey AS store_number, l_partkey AS item_id,
       CASE WHEN l_returnflag = 'A' THEN 'Non-Ecomm Sale' WHEN l_returnflag = 'N' THEN 'Ecomm Sale'
            WHEN l_linestatus = 'F' THEN 'Non-Ecomm Sale' END AS ecomm_flag
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

CTES["silver_customer"] = """
SELECT c_custkey AS ldw_customer_id, CAST(CAST(FLOOR(c_custkey / 2) AS BIGINT) AS VARCHAR(20)) AS card_number,
       CASE WHEN c_custkey % 2 = 1 THEN DATE '9999-12-31' ELSE DATE '2000-01-01' END AS eff_to_dt
FROM customer"""

CTES["silver_item"] = """
SELECT p_partkey AS id, CASE WHEN p_type = 'PROMO' THEN 'Y' ELSE 'N' END AS financial_sale_flag,
       DATE '2000-06-30' AS eff_to_dt FROM part
UNION ALL
SELECT p_partkey AS id, CASE WHEN p_type = 'PROMO' THEN 'N' ELSE 'Y' END AS financial_sale_flag,
       DATE '9999-12-31' AS eff_to_dt FROM part"""

CTES["silver_location"] = f"""
SELECT s_suppkey AS id, 'QF' AS banner_short_name, 'WH' AS location_type, DATE '1999-12-31' AS eff_to_dt FROM supplier
UNION ALL
SELECT s_suppkey AS id, {_BANNER} AS banner_short_name, {_TYPE} AS location_type, DATE '9999-12-31' AS eff_to_dt
FROM supplier"""

# Date bounds, looked up in the calendar table.
CTES["bounds"] = f"""
SELECT {_saturday_before('run_date')} AS last_saturday,
       {_sunday_from(_month_back('run_date'))} AS daily_start,
       {_month_back(_saturday_before('run_date'))} AS history_start
FROM (SELECT {RUN_DATE} AS run_date) r"""

CTES["week_bounds"] = """
SELECT b.last_saturday, m.week_end_date AS household_week, p.week_end_date AS card_week,
       q.week_end_date - 181 AS fact_start
FROM bounds b
JOIN date_dim m ON m.date = b.history_start
JOIN date_dim p ON p.date = m.week_end_date - 181
JOIN date_dim q ON q.date = p.week_end_date"""

CTES["daily_fact"] = """
SELECT f.* FROM retail_sale_fact f
JOIN bounds b ON f.fiscal_date >= b.daily_start AND f.fiscal_date <= b.last_saturday
JOIN location_dim l ON f.location_hk = l.location_hk AND l.current_banner_short_name IN ('SOF', 'UF', 'PSF')
JOIN item_dim i ON f.item_hk = i.item_hk AND i.current_financial_sale_flag = 'Y'"""

CTES["pos_daily_agg_card"] = f"""
SELECT fiscal_date, customer_hk, location_hk, channel, COUNT(DISTINCT transaction_number) AS transaction_count,
       SUM(merch_sales) AS sales, SUM(COALESCE(merch_scan_margin, 0)) AS scan,
       CAST(SUM(unit_count) AS BIGINT) AS units, CAST(SUM(item_count) AS BIGINT) AS items,
       {STAMP} AS dl_load_dt, {STAMP} AS dl_update_dt
FROM (SELECT f.*, CASE WHEN f.ecomm_flag = 'Non-Ecomm Sale' THEN 'In Store'
                       WHEN f.ecomm_flag = 'Ecomm Sale' AND r.id LIKE '%99' THEN 'Delivery'
                       WHEN f.ecomm_flag = 'Ecomm Sale' AND r.id LIKE '%97' THEN 'Pickup'
                       ELSE 'Adjustment' END AS channel
      FROM daily_fact f LEFT JOIN register_dim r ON f.register_hk = r.register_hk) s
GROUP BY fiscal_date, customer_hk, location_hk, channel"""

CTES["pos_daily_agg_hhn"] = f"""
SELECT p.fiscal_date, c.current_household_id AS hhn, p.location_hk, p.channel,
       CAST(SUM(p.transaction_count) AS BIGINT) AS transaction_count, SUM(p.sales) AS sales, SUM(p.scan) AS scan,
       CAST(SUM(p.units) AS BIGINT) AS units, CAST(SUM(p.items) AS BIGINT) AS items, {STAMP} AS dl_load_dt
FROM pos_daily_agg_card p JOIN customer_dim c ON p.customer_hk = c.customer_hk
GROUP BY p.fiscal_date, c.current_household_id, p.location_hk, p.channel"""

CTES["latest_card"] = """
SELECT card_number, ldw_customer_id FROM (
    SELECT *, row_number() OVER (PARTITION BY card_number ORDER BY eff_to_dt DESC) AS rn
    FROM silver_customer WHERE card_number <> '0') v
WHERE rn = 1"""

_SCOPES = {
    "sof": "('SOF', 'UF', 'PSF')",
    "buylow": "('BLF', 'NM', 'MFF')",
    "sof_only": "('SOF')",
    "uf_only": "('UF')",
    "psf_only": "('PSF')",
    "blf_only": "('BLF')",
    "nm_only": "('NM')",
    "mff_only": "('MFF')",
    "qf_only": "('QF')",
    "pfg": None,
}


def _scope_aggregates() -> str:
    parts = []
    for scope, banners in _SCOPES.items():
        for channel, sale in (("instore", "Non-Ecomm Sale"), ("ecom", "Ecomm Sale")):
            where = f"ecomm_flag = '{sale}'" + (f" AND banner IN {banners}" if banners else "")
            parts.append(f"MIN(day) FILTER (WHERE {where}) AS {scope}_{channel}_first_shop_date")
            parts.append(f"MAX(day) FILTER (WHERE {where}) AS {scope}_{channel}_last_shop_date")
    return ",\n       ".join(parts)


_SHOP_DATES = [
    f"{scope}_{channel}_{edge}_shop_date"
    for scope in [*_SCOPES, ]
    for channel in ("instore", "ecom")
    for edge in ("first", "last")
] + ["pfg_overall_first_shop_date", "pfg_overall_last_shop_date"]

CTES["card_shop_dates"] = f"""
SELECT k.card_number, a.* EXCLUDE (card_number),
       LEAST(a.pfg_instore_first_shop_date, a.pfg_ecom_first_shop_date) AS pfg_overall_first_shop_date,
       GREATEST(a.pfg_instore_last_shop_date, a.pfg_ecom_last_shop_date) AS pfg_overall_last_shop_date,
       {STAMP} AS dl_load_dt
FROM latest_card k LEFT JOIN (
    SELECT card_number,
       {_scope_aggregates()}
    FROM (
        SELECT k.card_number, CAST(s.fiscal_date AS DATE) AS day, s.ecomm_flag, l.banner_short_name AS banner
        FROM silver_retail_sale s
        JOIN (SELECT *, row_number() OVER (PARTITION BY id ORDER BY eff_to_dt DESC) AS rn FROM silver_item) i
          ON s.item_id = i.id AND i.rn = 1 AND i.financial_sale_flag = 'Y'
        JOIN (SELECT *, row_number() OVER (PARTITION BY id ORDER BY eff_to_dt DESC) AS rn FROM silver_location) l
          ON s.store_number = l.id AND l.rn = 1 AND l.location_type IN ('ST', 'CS', 'LS')
        JOIN latest_card k ON s.customer_id = k.ldw_customer_id
        JOIN bounds b ON CAST(s.fiscal_date AS DATE) <= b.last_saturday) v
    GROUP BY card_number) a ON k.card_number = a.card_number"""

CTES["household_shop_dates"] = f"""
SELECT c.hhn,
       {", ".join(f"{'MIN' if '_first_' in n else 'MAX'}(d.{n}) AS {n}" for n in _SHOP_DATES)},
       {STAMP} AS dl_load_dt
FROM card_shop_dates d
JOIN (SELECT DISTINCT card_number, current_household_id AS hhn FROM customer_dim WHERE card_number <> '0') c
  ON d.card_number = c.card_number
GROUP BY c.hhn"""

CTES["card_sales"] = """
SELECT c.card_number, f.fiscal_date, d.week_end_date, f.ecomm_flag, l.current_banner_short_name AS banner
FROM retail_sale_fact f
JOIN week_bounds b ON f.fiscal_date >= b.fact_start AND f.fiscal_date <= b.last_saturday
JOIN location_dim l ON f.location_hk = l.location_hk AND l.location_type IN ('ST', 'CS', 'LS')
 AND l.current_banner_short_name IN ('SOF', 'UF', 'PSF', 'BLF', 'NM', 'MFF')
JOIN item_dim i ON f.item_hk = i.item_hk AND i.current_financial_sale_flag = 'Y'
JOIN customer_dim c ON f.customer_hk = c.customer_hk AND c.card_number <> '0'
JOIN date_dim d ON f.fiscal_date = d.date"""

CTES["shopping_weeks"] = """
SELECT DISTINCT s.card_number, s.week_end_date FROM card_sales s JOIN week_bounds b ON s.week_end_date >= b.card_week"""

CTES["card_weeks"] = """
SELECT DISTINCT s.card_number, w.week_end_date
FROM shopping_weeks s
JOIN (SELECT DISTINCT week_end_date FROM date_dim) w
  ON w.week_end_date >= s.week_end_date AND w.week_end_date <= s.week_end_date + 175
JOIN week_bounds b ON w.week_end_date <= b.last_saturday"""

_GROUPS = {"sof": "('SOF', 'UF', 'PSF')", "blf": "('BLF', 'NM', 'MFF')"}
_CHANNELS = {"instore": "Non-Ecomm Sale", "ecomm": "Ecomm Sale"}
_WINDOWS = {"current_4wk": (27, 0), "current_13wk": (90, 0), "prior_13wk": (181, 91)}
_FLAGS = [f"{g}_{c}_{w}_flag" for g in _GROUPS for c in _CHANNELS for w in _WINDOWS]


def _flag_aggregates() -> str:
    parts = []
    for group, banners in _GROUPS.items():
        for channel, sale in _CHANNELS.items():
            for window, (oldest, newest) in _WINDOWS.items():
                hit = (
                    f"s.banner IN {banners} AND s.ecomm_flag = '{sale}' AND s.fiscal_date >= w.week_end_date - {oldest}"
                    f" AND s.fiscal_date <= w.week_end_date - {newest}"
                )
                parts.append(f"MAX(CASE WHEN {hit} THEN 1 ELSE 0 END) AS {group}_{channel}_{window}_flag")
    return ",\n       ".join(parts)


CTES["card_transactions"] = f"""
SELECT w.card_number, w.week_end_date,
       {_flag_aggregates()},
       {STAMP} AS dl_load_dt, {STAMP} AS dl_update_dt
FROM card_weeks w
LEFT JOIN (SELECT DISTINCT card_number, fiscal_date, banner, ecomm_flag FROM card_sales) s
  ON w.card_number = s.card_number AND s.fiscal_date >= w.week_end_date - 181 AND s.fiscal_date <= w.week_end_date
GROUP BY w.card_number, w.week_end_date"""

CTES["latest_household"] = """
SELECT card_number, current_household_id AS hhn FROM (
    SELECT *, row_number() OVER (PARTITION BY card_number ORDER BY eff_to_dt DESC) AS rn
    FROM customer_dim WHERE card_number <> '0') v
WHERE rn = 1"""

CTES["household_transactions"] = f"""
SELECT h.hhn, t.week_end_date, {", ".join(f"MAX(t.{n}) AS {n}" for n in _FLAGS)}, {STAMP} AS dl_load_dt
FROM card_transactions t
JOIN week_bounds b ON t.week_end_date >= b.household_week AND t.week_end_date <= b.last_saturday
JOIN latest_household h ON t.card_number = h.card_number
GROUP BY h.hhn, t.week_end_date"""

CTES["household_card_types"] = """
SELECT DISTINCT current_household_id AS hhn,
       CASE WHEN current_card_type = 'VMore Cards' THEN 'Customer Card' ELSE current_card_type END AS card_type
FROM (SELECT *, row_number() OVER (PARTITION BY card_number, current_household_id ORDER BY eff_to_dt DESC) AS rn
      FROM customer_dim) v
WHERE rn = 1"""

CTES["card_type_counts"] = """
SELECT hhn, card_type, COUNT(card_type) OVER (PARTITION BY hhn) AS card_type_count FROM household_card_types"""


def _type_case(card_type: str, mixed: str) -> str:
    return (
        f"CASE WHEN {mixed} OR {card_type} = 'Unknown' THEN 'Other'"
        f" WHEN {card_type} = 'Community Cards' THEN 'Community' WHEN {card_type} = 'Customer Card' THEN 'Customer'"
        f" WHEN {card_type} = 'Manager Cards' THEN 'Manager' WHEN {card_type} = 'Training Cards' THEN 'Training'"
        f" ELSE {card_type} END"
    )


CTES["household_types"] = f"""
SELECT DISTINCT hhn, {_type_case('card_type', 'card_type_count > 1')} AS hh_type FROM card_type_counts"""


CTES["types_per_household"] = """
SELECT hhn, COUNT(card_type) AS n_types, MIN(card_type) AS some_type, BOOL_OR(card_type IS NULL) AS missing
FROM household_card_types GROUP BY hhn"""

# The same by grouping instead of windowing.
CTES["household_types_grouped"] = f"""
SELECT hhn, 'Other' AS hh_type FROM types_per_household WHERE n_types > 1
UNION ALL SELECT hhn, {_type_case('some_type', 'FALSE')} FROM types_per_household WHERE n_types = 1
UNION ALL SELECT hhn, NULL FROM types_per_household WHERE n_types = 0 OR (n_types = 1 AND missing)"""


def _needed(names: list[str]) -> list[str]:
    """The named CTEs and everything they read, in definition order."""
    pending, found = list(names), set()
    while pending:
        name = pending.pop()
        if name in found:
            continue
        found.add(name)
        words = set(CTES[name].replace("(", " ").replace(")", " ").split())
        pending.extend(other for other in CTES if other in words and other != name)
    return [name for name in CTES if name in found]


def _sql(body: str, *names: str) -> str:
    with_list = ",\n".join(f"{name} AS ({CTES[name]}\n)" for name in _needed(list(names)))
    return f"WITH {with_list}\n{body.strip()}"


_MONEY = "REPLACE (CAST(sales AS DOUBLE) AS sales, CAST(scan AS DOUBLE) AS scan)"
_ORDER_DAYS = "(SELECT o_orderkey, CAST(o_orderdate AS DATE) AS run_date FROM orders) d"

ORACLES: dict[str, str] = {
    "pos_daily_agg_card": _sql(f"SELECT * {_MONEY} FROM pos_daily_agg_card", "pos_daily_agg_card"),
    "pos_daily_agg_hhn": _sql(f"SELECT * {_MONEY} FROM pos_daily_agg_hhn", "pos_daily_agg_hhn"),
    "card_shop_dates": _sql("SELECT * FROM card_shop_dates", "card_shop_dates"),
    "household_shop_dates": _sql("SELECT * FROM household_shop_dates", "household_shop_dates"),
    "card_transactions": _sql("SELECT * FROM card_transactions", "card_transactions"),
    "household_transactions": _sql("SELECT * FROM household_transactions", "household_transactions"),
    "household_transactions_from_sales": _sql("SELECT * FROM household_transactions", "household_transactions"),
    "household_transactions_from_cards": _sql("SELECT * FROM household_transactions", "household_transactions"),
    "household_type": _sql(f"SELECT *, {STAMP} AS dl_load_dt FROM household_types", "household_types"),
    # projections, filters, expressions
    "project_fact": _sql(
        "SELECT fiscal_date, location_hk, customer_hk, item_hk, ecomm_flag FROM retail_sale_fact", "retail_sale_fact"
    ),
    "audit_stamp": _sql(f"SELECT *, {STAMP} AS dl_load_dt, {STAMP} AS dl_update_dt FROM customer_dim", "customer_dim"),
    "filter_isin": _sql(
        "SELECT * FROM location_dim WHERE location_type IN ('ST', 'CS', 'LS') AND current_banner_short_name IN"
        " ('SOF', 'UF', 'PSF', 'BLF', 'NM', 'MFF')",
        "location_dim",
    ),
    "filter_financial_items": _sql("SELECT item_hk FROM item_dim WHERE current_financial_sale_flag = 'Y'", "item_dim"),
    "filter_sentinel_card": _sql("SELECT * FROM customer_dim WHERE card_number <> '0'", "customer_dim"),
    "filter_date_range": _sql(
        "SELECT fiscal_date, transaction_number, customer_hk FROM retail_sale_fact"
        " WHERE fiscal_date BETWEEN DATE '1998-12-27' AND DATE '2001-07-28'",
        "retail_sale_fact",
    ),
    "channel_case": _sql(
        """
SELECT f.transaction_number, f.ecomm_flag, r.id,
       CASE WHEN f.ecomm_flag = 'Non-Ecomm Sale' THEN 'In Store'
            WHEN f.ecomm_flag = 'Ecomm Sale' AND right(r.id, 2) = '99' THEN 'Delivery'
            WHEN f.ecomm_flag = 'Ecomm Sale' AND right(r.id, 2) = '97' THEN 'Pickup' ELSE 'Adjustment' END AS channel
FROM retail_sale_fact f LEFT JOIN register_dim r ON f.register_hk = r.register_hk""",
        "retail_sale_fact",
        "register_dim",
    ),
    "hh_type_case": _sql(
        f"""
SELECT customer_hk, current_card_type, {_type_case('card_type', 'FALSE')} AS hh_type
FROM (SELECT *, CASE WHEN current_card_type = 'VMore Cards' THEN 'Customer Card' ELSE current_card_type END AS card_type
      FROM customer_dim) c""",
        "customer_dim",
    ),
    "cast_timestamps": "SELECT o_orderkey, CAST(CAST(o_orderdate AS VARCHAR) AS TIMESTAMP) AS o_orderdate FROM orders",
    "last_saturday": f"SELECT *, {_saturday_before('run_date')} AS last_saturday FROM {_ORDER_DAYS}",
    "last_sunday": f"SELECT *, {_sunday_from('run_date')} AS last_sunday FROM {_ORDER_DAYS}",
    "calendar_windows": _sql(
        f"""
SELECT d.o_orderkey, d.run_date, w.week_end_date, w.week_end_date - 27 AS current_4wk_start_dt,
       w.week_end_date - 90 AS current_13wk_start_dt, w.week_end_date - 181 AS prior_13wk_start_dt,
       w.week_end_date - 91 AS prior_13wk_end_dt, w.week_end_date + 175 AS future_26wk_end_dt
FROM {_ORDER_DAYS} JOIN date_dim w ON d.run_date = w.date""",
        "date_dim",
    ),
    "calendar_bounds": f"""
SELECT o_orderkey, run_date, {_sunday_from(_month_back('run_date'))} AS first_day, last_day, history_start,
       household_first_week, {_week_end('(household_first_week - 181)')} AS card_first_week,
       {_week_end('(household_first_week - 181)')} - 181 AS fact_first_day
FROM (SELECT *, {_week_end('history_start')} AS household_first_week
      FROM (SELECT *, {_month_back('last_day')} AS history_start
            FROM (SELECT *, {_saturday_before('run_date')} AS last_day FROM {_ORDER_DAYS}) a) b) c""",
    "overall_first_last": _sql(
        "SELECT card_number, " + ", ".join(n for n in _SHOP_DATES if n.startswith("pfg_")) + " FROM card_shop_dates",
        "card_shop_dates",
    ),
    # joins
    "join_inner_location": _sql(
        "SELECT f.transaction_number, f.location_hk, l.current_banner_short_name, l.location_type"
        " FROM retail_sale_fact f JOIN location_dim l ON f.location_hk = l.location_hk",
        "retail_sale_fact",
        "location_dim",
    ),
    "join_inner_item": _sql(
        "SELECT f.transaction_number, f.item_hk FROM retail_sale_fact f"
        " JOIN item_dim i ON f.item_hk = i.item_hk WHERE i.current_financial_sale_flag = 'Y'",
        "retail_sale_fact",
        "item_dim",
    ),
    "join_inner_customer": _sql(
        "SELECT f.transaction_number, f.customer_hk, c.card_number, c.current_household_id"
        " FROM retail_sale_fact f JOIN customer_dim c ON f.customer_hk = c.customer_hk",
        "retail_sale_fact",
        "customer_dim",
    ),
    "join_calendar": _sql(
        "SELECT transaction_number, fiscal_date, CAST(fiscal_date + CAST(6 - dayofweek(fiscal_date) AS INTEGER) AS DATE)"
        " AS week_end_date FROM retail_sale_fact",
        "retail_sale_fact",
    ),
    "join_left_register": _sql(
        "SELECT f.transaction_number, f.register_hk, r.id"
        " FROM retail_sale_fact f LEFT JOIN register_dim r ON f.register_hk = r.register_hk",
        "retail_sale_fact",
        "register_dim",
    ),
    "distinct_card_weeks": _sql("SELECT * FROM shopping_weeks", "shopping_weeks"),
    "range_join_weeks": _sql("SELECT * FROM card_weeks", "card_weeks"),
    "semi_join_flag": _sql(
        """
SELECT w.card_number, w.week_end_date, 1 AS sof_instore_prior_13wk_flag FROM card_weeks w
WHERE EXISTS (SELECT 1 FROM card_sales s WHERE s.card_number = w.card_number AND s.banner IN ('SOF', 'UF', 'PSF')
              AND s.ecomm_flag = 'Non-Ecomm Sale'
              AND s.fiscal_date BETWEEN w.week_end_date - 181 AND w.week_end_date - 91)""",
        "card_weeks",
        "card_sales",
    ),
    "join_left_two_keys": _sql(
        """
SELECT w.card_number, w.week_end_date,
       CASE WHEN EXISTS (SELECT 1 FROM card_sales s WHERE s.card_number = w.card_number
                         AND s.banner IN ('BLF', 'NM', 'MFF') AND s.ecomm_flag = 'Ecomm Sale'
                         AND s.fiscal_date BETWEEN w.week_end_date - 27 AND w.week_end_date)
            THEN 1 ELSE 0 END AS blf_ecomm_current_4wk_flag
FROM card_weeks w""",
        "card_weeks",
        "card_sales",
    ),
    "join_right_all_cards": _sql(
        "SELECT k.card_number, k.ldw_customer_id, d.qf_only_ecom_last_shop_date"
        " FROM card_shop_dates d RIGHT JOIN latest_card k ON d.card_number = k.card_number",
        "card_shop_dates",
        "latest_card",
    ),
    "join_latest_subquery": _sql(
        """
SELECT w.card_number, w.week_end_date, n.current_household_id AS hhn
FROM shopping_weeks w JOIN customer_dim n ON w.card_number = n.card_number
WHERE n.eff_to_dt = (SELECT MAX(eff_to_dt) FROM customer_dim v WHERE v.card_number = n.card_number)""",
        "shopping_weeks",
        "customer_dim",
    ),
    # aggregates, windows, versions
    "agg_count_distinct": _sql(
        "SELECT location_hk, COUNT(DISTINCT transaction_number) AS transaction_count FROM retail_sale_fact"
        " GROUP BY location_hk",
        "retail_sale_fact",
    ),
    "agg_sum_coalesce": _sql(
        "SELECT customer_hk, CAST(SUM(COALESCE(merch_scan_margin, 0)) AS DOUBLE) AS scan FROM retail_sale_fact"
        " GROUP BY customer_hk",
        "retail_sale_fact",
    ),
    "scd_latest_by_card": _sql("SELECT * FROM latest_household", "latest_household"),
    "scd_latest_by_card_household": _sql(
        """
SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY card_number, current_household_id ORDER BY eff_to_dt DESC) AS rn
    FROM customer_dim) v
WHERE rn = 1""",
        "customer_dim",
    ),
    "scd_latest_item": _sql(
        "SELECT i.* FROM silver_item i JOIN (SELECT id, MAX(eff_to_dt) AS newest FROM silver_item GROUP BY id) n"
        " ON i.id = n.id AND i.eff_to_dt = n.newest",
        "silver_item",
    ),
    "scd_latest_location": _sql(
        "SELECT l.* FROM silver_location l JOIN (SELECT id, MAX(eff_to_dt) AS newest FROM silver_location GROUP BY id) n"
        " ON l.id = n.id AND l.eff_to_dt = n.newest",
        "silver_location",
    ),
    "window_count_card_types": _sql("SELECT * FROM card_type_counts", "card_type_counts"),
    # sinks and data quality
    "sink_partitioned_roundtrip": _sql(
        "SELECT * FROM card_transactions WHERE week_end_date BETWEEN DATE '2001-05-05' AND DATE '2001-07-28'",
        "card_transactions",
    ),
    "dq_duplicates": _sql(
        "SELECT hhn, COUNT(*) AS cnt FROM household_types GROUP BY hhn HAVING COUNT(*) > 1", "household_types"
    ),
    "dq_nulls": _sql(
        "\nUNION ALL\n".join(
            f"SELECT '{column}' AS column_name, COUNT(*) FILTER (WHERE {column} IS NULL) AS null_count FROM {table}"
            for table, columns in {
                "retail_sale_fact": ["ecomm_flag", "merch_sales", "merch_scan_margin"],
                "pos_daily_agg_card": ["transaction_count", "sales", "scan", "units", "items"],
                "household_types": ["hhn", "hh_type"],
            }.items()
            for column in columns
        ),
        "retail_sale_fact",
        "pos_daily_agg_card",
        "household_types",
    ),
    "dq_flag_implication": _sql(
        "\nUNION ALL\n".join(
            f"SELECT '{s}_current_4wk_flag' AS premise, COUNT(*) FILTER (WHERE {s}_current_4wk_flag = 1) AS premise_rows,"
            f" COUNT(*) FILTER (WHERE {s}_current_4wk_flag = 1 AND {s}_current_13wk_flag <> 1) AS broken_rows"
            " FROM card_transactions"
            for s in ("sof_instore", "sof_ecomm", "blf_instore", "blf_ecomm")
        ),
        "card_transactions",
    ),
    "dq_missing_keys": _sql(
        """
SELECT DISTINCT current_household_id AS hhn FROM customer_dim
WHERE card_number <> '0' AND current_household_id <> '0' AND current_household_id IS NOT NULL
EXCEPT SELECT hhn FROM household_transactions""",
        "customer_dim",
        "household_transactions",
    ),
    "dq_distinct_count_recon": _sql(
        """
SELECT (SELECT COUNT(*) FROM src) AS source_rows, (SELECT COUNT(*) FROM tgt) AS target_rows,
       (SELECT COUNT(*) FROM (SELECT * FROM src EXCEPT SELECT * FROM tgt) x) AS only_in_source,
       (SELECT COUNT(*) FROM (SELECT * FROM tgt EXCEPT SELECT * FROM src) x) AS only_in_target
FROM (SELECT 1) one""".replace(
            "FROM src", "FROM (SELECT DISTINCT c.card_number FROM daily_fact f JOIN customer_dim c USING (customer_hk)) s"
        ).replace(
            "FROM tgt",
            "FROM (SELECT DISTINCT c.card_number FROM pos_daily_agg_card p JOIN customer_dim c USING (customer_hk)) t",
        ),
        "daily_fact",
        "pos_daily_agg_card",
        "customer_dim",
    ),
    "dq_row_mismatch": _sql(
        """
SELECT (SELECT COUNT(*) FROM household_types_grouped) AS source_rows,
       (SELECT COUNT(*) FROM household_types) AS target_rows,
       (SELECT COUNT(*) FROM (SELECT * FROM household_types_grouped EXCEPT SELECT * FROM household_types) a)
           AS only_in_source,
       (SELECT COUNT(*) FROM (SELECT * FROM household_types EXCEPT SELECT * FROM household_types_grouped) b)
           AS only_in_target""",
        "household_types",
        "household_types_grouped",
    ),
}


def _empty_check(table: str, case: str, violations: str) -> str:
    return _check(table, case, f"(SELECT COUNT(*) FROM ({violations}) v) = 0")


def _check(table: str, case: str, condition: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, CASE WHEN {condition} THEN 'Pass' ELSE 'Fail' END AS test_result,"
        f" '{case}' AS test_case_name, '2001-08-01 00:00:00' AS execution_date"
    )


def _duplicates(table: str, keys: str) -> str:
    return f"SELECT {keys} FROM {table} GROUP BY {keys} HAVING COUNT(*) > 1"


def _flag_checks(table: str, keys: str) -> list[str]:
    nulls = " OR ".join(f"{n} IS NULL" for n in _FLAGS)
    broken = " UNION ".join(
        f"SELECT {keys} FROM {table} WHERE {s}_current_4wk_flag = 1 AND {s}_current_4wk_flag <> {s}_current_13wk_flag"
        for s in ("sof_instore", "sof_ecomm", "blf_instore", "blf_ecomm")
    )
    return [
        _empty_check(table, "Columns Null Check", f"SELECT {keys} FROM {table} WHERE {nulls}"),
        _empty_check(table, "Flag values Check", broken),
    ]


def _same_rows(left: str, right: str) -> str:
    return (
        f"(SELECT COUNT(*) FROM (({left}) EXCEPT ({right})) l) = 0"
        f" AND (SELECT COUNT(*) FROM (({right}) EXCEPT ({left})) r) = 0"
    )


_COVERAGE = "Verifying that {} table includes all {} from client table"
_SOURCE = "SELECT DISTINCT c.{} AS k FROM daily_fact f JOIN customer_dim c ON f.customer_hk = c.customer_hk"

ORACLES["dq_report"] = _sql(
    "\nUNION ALL\n".join(
        [
            *[
                _check(name, "Column Def Check", "TRUE")
                for name in (
                    "pos_daily_agg_card",
                    "pos_daily_agg_hhn",
                    "card_transactions",
                    "household_transactions",
                    "Gold_Card_Shop_Dates",
                    "Gold_Household_Shop_Dates",
                    "Gold_Household_Type",
                )
            ],
            *[
                _empty_check(label, case, _duplicates(table, keys))
                for label, case, table, keys in (
                    (
                        "pos_daily_agg_card",
                        "Data duplication Check",
                        "pos_daily_agg_card",
                        "fiscal_date, customer_hk, location_hk, channel",
                    ),
                    (
                        "pos_daily_agg_hhn",
                        "Data duplication Check",
                        "pos_daily_agg_hhn",
                        "fiscal_date, hhn, location_hk, channel",
                    ),
                    ("card_transactions", "Data duplication Check", "card_transactions", "card_number, week_end_date"),
                    ("household_transactions", "Data duplication Check", "household_transactions", "hhn, week_end_date"),
                    ("Gold_Card_Shop_Dates", "Duplicate Records Check", "card_shop_dates", "card_number"),
                    ("Gold_Household_Shop_Dates", "Duplicate Records Check", "household_shop_dates", "hhn"),
                    ("Gold_Household_Type", "Data duplication Check", "household_types", "hhn"),
                )
            ],
            *[
                _empty_check(table, "Scan Column Null Check", f"SELECT 1 FROM {table} WHERE scan IS NULL")
                for table in ("pos_daily_agg_card", "pos_daily_agg_hhn")
            ],
            *_flag_checks("card_transactions", "card_number, week_end_date"),
            *_flag_checks("household_transactions", "hhn, week_end_date"),
            _check(
                "pos_daily_agg_card",
                "card numbers count Check",
                _same_rows(
                    _SOURCE.format("card_number"),
                    "SELECT DISTINCT c.card_number FROM pos_daily_agg_card p"
                    " JOIN customer_dim c ON p.customer_hk = c.customer_hk",
                ),
            ),
            _check(
                "pos_daily_agg_hhn",
                "household count Check",
                _same_rows(_SOURCE.format("current_household_id"), "SELECT DISTINCT hhn FROM pos_daily_agg_hhn"),
            ),
            _empty_check(
                "household_transactions",
                "HHN Count Check",
                "SELECT h.hhn FROM card_transactions t JOIN week_bounds b ON t.week_end_date >= b.household_week"
                " JOIN latest_household h ON t.card_number = h.card_number"
                " EXCEPT SELECT hhn FROM household_transactions",
            ),
            _empty_check(
                "Gold_Card_Shop_Dates",
                _COVERAGE.format("card_shop_dates", "card numbers"),
                "SELECT card_number FROM silver_customer WHERE card_number <> '0'"
                " EXCEPT SELECT card_number FROM card_shop_dates",
            ),
            _empty_check(
                "Gold_Household_Shop_Dates",
                _COVERAGE.format("household_shop_dates", "household_ids"),
                "SELECT current_household_id FROM customer_dim WHERE card_number <> '0' AND current_household_id <> '0'"
                " EXCEPT SELECT hhn FROM household_shop_dates",
            ),
            _empty_check(
                "Gold_Household_Type",
                "Household Type Check",
                "SELECT * FROM household_types EXCEPT SELECT * FROM household_types_grouped",
            ),
        ]
    ),
    *[name for name in CTES],
)

# --- interval joins, long windows, comparisons, counts ------------------------------------------

ORACLES["interval_join_campaigns"] = _sql(
    """
    SELECT c.location_hk, c.campaign, w.week_end_date, w.activity_window
    FROM (
        SELECT location_hk, 'opening' AS campaign, MIN(fiscal_date) AS from_day,
               MIN(fiscal_date) + CAST(location_hk % 60 AS INTEGER) AS to_day FROM retail_sale_fact GROUP BY location_hk
        UNION ALL
        SELECT location_hk, 'closing', MAX(fiscal_date) - CAST(location_hk % 400 AS INTEGER), MAX(fiscal_date)
        FROM retail_sale_fact GROUP BY location_hk
    ) c
    JOIN (
        SELECT d.week_end_date, v.activity_window, d.week_end_date - v.oldest AS start_dt, d.week_end_date - v.newest AS end_dt
        FROM (SELECT DISTINCT week_end_date FROM orders JOIN date_dim ON CAST(o_orderdate AS DATE) = date) d,
             (VALUES ('current_4wk', 27, 0), ('current_13wk', 90, 0), ('prior_13wk', 181, 91)) AS v(activity_window, oldest, newest)
    ) w ON c.from_day <= w.end_dt AND w.start_dt <= c.to_day
    """,
    "retail_sale_fact",
    "date_dim",
)

_LONG_WINDOWS = {"last_52wk": (363, 0), "prior_52wk": (727, 364), "last_104wk": (727, 0)}
_LONG_FLAGS = [f"{g}_{c}_{w}_flag" for g in _GROUPS for c in _CHANNELS for w in _LONG_WINDOWS]

CTES["long_card_weeks"] = """
SELECT DISTINCT s.card_number, w.week_end_date
FROM (SELECT DISTINCT card_number, week_end_date FROM card_sales) s
JOIN (SELECT DISTINCT week_end_date FROM date_dim) w
  ON w.week_end_date >= s.week_end_date AND w.week_end_date <= s.week_end_date + 721
JOIN week_bounds b ON w.week_end_date >= b.card_week AND w.week_end_date <= b.last_saturday"""

CTES["card_activity_two_years"] = f"""
SELECT w.card_number, w.week_end_date,
       {", ".join(
           f"MAX(CASE WHEN s.banner IN {banners} AND s.ecomm_flag = '{sale}' AND s.fiscal_date >= w.week_end_date - {oldest}"
           f" AND s.fiscal_date <= w.week_end_date - {newest} THEN 1 ELSE 0 END) AS {group}_{channel}_{window}_flag"
           for group, banners in _GROUPS.items()
           for channel, sale in _CHANNELS.items()
           for window, (oldest, newest) in _LONG_WINDOWS.items()
       )}
FROM long_card_weeks w
JOIN (SELECT DISTINCT card_number, fiscal_date, banner, ecomm_flag FROM card_sales) s
  ON w.card_number = s.card_number AND s.fiscal_date >= w.week_end_date - 727 AND s.fiscal_date <= w.week_end_date
GROUP BY w.card_number, w.week_end_date"""

ORACLES["card_activity_two_years"] = _sql("SELECT * FROM card_activity_two_years", "card_activity_two_years")
ORACLES["household_activity_two_years"] = _sql(
    f"""
    SELECT h.hhn, t.week_end_date, {", ".join(f"MAX(t.{n}) AS {n}" for n in _LONG_FLAGS)}
    FROM card_activity_two_years t JOIN latest_household h ON t.card_number = h.card_number
    GROUP BY h.hhn, t.week_end_date
    """,
    "card_activity_two_years",
    "latest_household",
)

_DAILY_ROW = "fiscal_date, customer_hk, location_hk, channel, transaction_count, units, items"
ORACLES["dq_row_differences"] = _sql(
    f"""
    SELECT {_DAILY_ROW}, CAST(SUM(s) AS BIGINT) AS source_rows, CAST(SUM(t) AS BIGINT) AS target_rows
    FROM (
        SELECT {_DAILY_ROW}, 1 AS s, 0 AS t FROM pos_daily_agg_card
        UNION ALL
        SELECT * REPLACE (CASE WHEN customer_hk % 89 = 3 THEN units + 1 ELSE units END AS units)
        FROM (SELECT {_DAILY_ROW}, 0 AS s, 1 AS t FROM pos_daily_agg_card WHERE customer_hk % 97 <> 5) x
    ) both_sides
    GROUP BY {_DAILY_ROW} HAVING SUM(s) <> SUM(t)
    """,
    "pos_daily_agg_card",
)

ORACLES["dq_counted_while_written"] = _sql(
    f"""
    SELECT 'pos_daily_agg_card' AS table_name, 'rows' AS metric, COUNT(*) AS value FROM pos_daily_agg_card
    UNION ALL
    SELECT 'pos_daily_agg_card', 'Scan Column Null Check', COUNT(*) FILTER (WHERE scan IS NULL) FROM pos_daily_agg_card
    UNION ALL
    SELECT 'card_transactions', 'rows', COUNT(*) FROM card_transactions
    UNION ALL
    SELECT 'card_transactions', 'Columns Null Check', COUNT(*) FILTER (WHERE {" OR ".join(f"{n} IS NULL" for n in _FLAGS)})
    FROM card_transactions
    UNION ALL
    SELECT 'card_transactions', 'Flag values Check', COUNT(*) FILTER (WHERE {" OR ".join(
        f"{s}_current_4wk_flag = 1 AND {s}_current_4wk_flag <> {s}_current_13wk_flag"
        for s in ("sof_instore", "sof_ecomm", "blf_instore", "blf_ecomm")
    )}) FROM card_transactions
    """,
    "pos_daily_agg_card",
    "card_transactions",
)

ORACLES["daily_sales_of_changed_days"] = _sql(
    """
    SELECT fiscal_date, customer_hk, location_hk, channel, transaction_count, CAST(sales AS DOUBLE) AS sales,
           CAST(scan AS DOUBLE) AS scan, units, items,
           dayofyear(fiscal_date) % 31 = 3 OR dayofyear(fiscal_date) % 29 = 5 AS rebuilt
    FROM pos_daily_agg_card
    """,
    "pos_daily_agg_card",
)

ORACLES["distinct_transactions_by_household"] = _sql(
    """
    SELECT current_household_id AS hhn, COUNT(DISTINCT transaction_number) AS transaction_count
    FROM retail_sale_fact JOIN customer_dim USING (customer_hk) GROUP BY current_household_id
    """,
    "retail_sale_fact",
    "customer_dim",
)

ORACLES["dq_deviating_files"] = """
    SELECT partition, missing, extra, misplaced, retyped
    FROM (VALUES (1996, 'year=1996', '', '', false, 'o_totalprice'), (1997, 'year=1997', '', '', true, ''),
                 (1998, 'year=1998', 'o_custkey', '', false, ''), (1999, 'year=1999', '', 'o_orderstatus', false, ''))
         AS odd(year, partition, missing, extra, misplaced, retyped)
    WHERE year IN (SELECT EXTRACT(YEAR FROM CAST(o_orderdate AS DATE)) FROM orders)
"""
