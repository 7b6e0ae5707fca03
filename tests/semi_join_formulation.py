"""Card activity written the plain way: one range semi-join and one left join per flag.

Independent of the bitmap plan; tests compare the two and bench.py can time them side by side.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll import domain
from tillroll.functions import calendar
from tillroll.functions.retail import stamped
from tillroll.operators.spans import flag_in_window, spread_weeks
from tillroll.plans.activity import identified_cards, weekly_facts
from tillroll.sources.tables import GoldTables


def card_transactions(tables: GoldTables, as_of: datetime) -> DataFrame:
    bounds = calendar.WeeklyBounds.of(as_of.date())
    cards = identified_cards(tables.customer_dim).select("customer_hk", "card_number")
    sales = weekly_facts(tables, bounds).join(cards, "customer_hk")
    weeks = sales.withColumn("week_end_date", calendar.week_end_of(F.col("fiscal_date")))
    weeks = weeks.filter(F.col("week_end_date") >= bounds.card_first_week)
    spine = spread_weeks(weeks, "card_number", "week_end_date", domain.SPREAD_WEEKS, F.lit(bounds.last_day))
    keys = ["card_number", "week_end_date"]
    dated = spine.withColumns(calendar.window_dates(F.col("week_end_date")))
    result = spine
    for group, banners in domain.BANNER_GROUPS.items():
        for channel, ecomm_flag in domain.FLAG_CHANNELS.items():
            sold = F.col("current_banner_short_name").isin(*banners) & (F.col("ecomm_flag") == ecomm_flag)
            for window in domain.ACTIVITY_WINDOWS:
                name = f"{group}_{channel}_{window}_flag"
                end = f"{window}_end_dt" if f"{window}_end_dt" in dated.columns else "week_end_date"
                flagged = flag_in_window(
                    dated, sales, "card_number", "fiscal_date", f"{window}_start_dt", end, name, sold
                )
                result = result.join(flagged.select(*keys, name), keys, "left")
    result = result.fillna(0, domain.flag_columns())
    return stamped(result, as_of, "dl_load_dt", "dl_update_dt").select(*domain.TABLE_COLUMNS["card_transactions"])
