from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests import semi_join_formulation
from tests.small_tables import CURRENT, ECOMM, IN_STORE, STORES, gold, sale
from tillroll.domain import ACTIVITY_WINDOWS, BANNER_GROUPS, FLAG_CHANNELS, LOCATION_TYPES, TABLE_COLUMNS, flag_columns
from tillroll.functions.calendar import WeeklyBounds, week_end
from tillroll.operators.activity import flags_per_week, weekly_bitmaps, with_history
from tillroll.operators.spans import flag_in_window, spread_weeks
from tillroll.plans import activity
from tillroll.plans.activity import card_transactions, household_transactions, household_transactions_from_sales

AS_OF = datetime(2001, 8, 1)
BOUNDS = WeeklyBounds.of(AS_OF.date())
CARD = [(10, "5", "h", None, CURRENT)]


def _weeks(n):
    return timedelta(weeks=n)


def _flags(spark, sales, customers=CARD):
    return card_transactions(gold(spark, sales, customers), AS_OF)


def test_one_sale_makes_26_rows(spark):
    week = date(1999, 6, 5)
    rows = {r.week_end_date: r for r in _flags(spark, [sale(week - timedelta(days=3))]).collect()}
    assert sorted(rows) == [week + _weeks(k) for k in range(26)]
    for k in range(26):
        row = rows[week + _weeks(k)]
        assert row.sof_instore_current_4wk_flag == int(k <= 3)
        assert row.sof_instore_current_13wk_flag == int(k <= 12)
        assert row.sof_instore_prior_13wk_flag == int(13 <= k <= 25)
        assert sum(row[name] for name in flag_columns() if not name.startswith("sof_instore")) == 0


def test_rows_end_with_the_last_full_week(spark):
    rows = _flags(spark, [sale(date(2001, 7, 28)), sale(date(2001, 7, 29), customer=10)]).collect()
    assert [r.week_end_date for r in rows] == [date(2001, 7, 28)]


def test_early_sale_sets_flags_but_makes_no_rows(spark):
    early = BOUNDS.card_first_week - _weeks(14)
    assert _flags(spark, [sale(early)]).count() == 0
    rows = {r.week_end_date: r for r in _flags(spark, [sale(early), sale(BOUNDS.card_first_week, store=2)]).collect()}
    assert min(rows) == BOUNDS.card_first_week and len(rows) == 26
    assert [rows[BOUNDS.card_first_week + _weeks(k)].sof_instore_prior_13wk_flag for k in range(13)] == [1] * 12 + [0]


def test_sale_without_channel_makes_rows_without_flags(spark):
    rows = _flags(spark, [sale(date(1999, 6, 5), flag=None)]).collect()
    assert len(rows) == 26
    assert {row[name] for row in rows for name in flag_columns()} == {0}


def test_sales_outside_the_scope_are_ignored(spark):
    day = date(1999, 6, 5)
    dropped = [sale(day, store=3), sale(day, store=4), sale(day, item=2), sale(day, customer=99), sale(day, customer=98),
               sale(BOUNDS.fact_first_day - timedelta(days=1))]
    customers = [*CARD, (99, "0", "h", None, CURRENT), (98, None, "h", None, CURRENT)]
    assert _flags(spark, dropped, customers).count() == 0


def _brute_force(sales, customers):
    """Card weeks and flags by trying every week for every card."""
    cards = {hk: card for hk, card, *_ in customers}
    stores = {hk: banner for hk, banner, kind in STORES if kind in LOCATION_TYPES}
    groups = {banner for banners in BANNER_GROUPS.values() for banner in banners}
    events = {}
    for day, _, customer, store, item, _, flag, *_ in sales:
        known = cards.get(customer, "0") != "0" and stores.get(store) in groups and item == 1
        if known and BOUNDS.fact_first_day <= day <= BOUNDS.last_day:
            events.setdefault(cards[customer], set()).add((day, stores[store], flag))
    expected = {}
    for card, seen in events.items():
        week = BOUNDS.card_first_week
        while week <= BOUNDS.last_day:
            starts = [week_end(d) for d, _, _ in seen if week_end(d) >= BOUNDS.card_first_week]
            if any(start <= week <= start + _weeks(25) for start in starts):
                flags = {}
                for group, banners in BANNER_GROUPS.items():
                    for channel, ecomm_flag in FLAG_CHANNELS.items():
                        for name, (newest, oldest) in ACTIVITY_WINDOWS.items():
                            first, last = week - _weeks(oldest) - timedelta(days=6), week - _weeks(newest)
                            flags[f"{group}_{channel}_{name}_flag"] = int(
                                any(first <= d <= last and b in banners and f == ecomm_flag for d, b, f in seen)
                            )
                expected[card, week] = flags
            week += _weeks(1)
    return expected


@pytest.fixture(scope="module")
def random_tables(spark):
    rng = random.Random(7)
    customers = [(hk, str(hk // 2), f"h{hk // 4}" if hk % 5 else None, None, date(2000 + hk % 2, 1, 1)) for hk in range(40)]
    span = (BOUNDS.last_day - BOUNDS.fact_first_day).days + 60
    sales = [
        sale(
            BOUNDS.fact_first_day - timedelta(days=30) + timedelta(days=rng.randrange(span)),
            txn,
            rng.choice(range(42)),
            rng.choice([1, 1, 2, 2, 3, 4, 5]),
            rng.choice([1, 1, 1, 2]),
            1,
            rng.choice([IN_STORE, ECOMM, None]),
        )
        for txn in range(400)
    ]
    return sales, customers, gold(spark, sales, customers)


def test_card_flags_match_brute_force(random_tables):
    sales, customers, tables = random_tables
    df = card_transactions(tables, AS_OF)
    assert df.columns == TABLE_COLUMNS["card_transactions"]
    rows = df.collect()
    found = {(r.card_number, r.week_end_date): {name: r[name] for name in flag_columns()} for r in rows}
    assert len(found) == len(rows) > 500
    assert found == _brute_force(sales, customers)


def test_bitmaps_and_semi_joins_agree(random_tables):
    tables = random_tables[2]
    bitmaps = card_transactions(tables, AS_OF)
    semi_joins = semi_join_formulation.card_transactions(tables, AS_OF)
    assert bitmaps.exceptAll(semi_joins).count() == semi_joins.exceptAll(bitmaps).count() == 0


def test_household_flags_are_the_same_from_the_table_and_from_the_sales(random_tables):
    tables = random_tables[2]
    stored = household_transactions(card_transactions(tables, AS_OF), tables.customer_dim, AS_OF)
    direct = household_transactions_from_sales(tables, AS_OF)
    assert stored.columns == direct.columns == TABLE_COLUMNS["household_transactions"]
    assert stored.count() > 0
    assert stored.exceptAll(direct).count() == direct.exceptAll(stored).count() == 0


def test_household_uses_the_latest_version_of_a_card(spark):
    customers = [(10, "5", "old", None, date(2000, 1, 1)), (11, "5", "new", None, CURRENT)]
    tables = gold(spark, [sale(date(2001, 7, 27), customer=10)], customers)
    rows = household_transactions(card_transactions(tables, AS_OF), tables.customer_dim, AS_OF).collect()
    assert [(r.hhn, r.week_end_date) for r in rows] == [("new", date(2001, 7, 28))]


def test_shorter_history_is_a_parameter(spark):
    tables = gold(spark, [sale(date(1999, 6, 5)), sale(date(2001, 6, 2))], CARD)
    assert {r.week_end_date.year for r in card_transactions(tables, AS_OF, months=3).collect()} == {2001}


def test_windows_beyond_the_history_are_refused(spark):
    empty = spark.createDataFrame([], "k string, block int, visits bigint, s bigint")
    with pytest.raises(ValueError):
        flags_per_week(empty, "k", "visits", ["s"], {"long": (0, 33)}, date(2001, 1, 6), date(2001, 2, 3))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    weeks=st.lists(st.integers(-70, 200), min_size=1, max_size=12),
    windows=st.lists(st.tuples(st.integers(0, 32), st.integers(0, 32)), min_size=1, max_size=3),
    first=st.integers(-80, 100),
    length=st.integers(0, 150),
)
def test_bitmap_flags_for_any_windows(spark, weeks, windows, first, length):
    """Weeks around 1970 as well, so that block borders and negative week numbers are met."""
    origin = date(1970, 1, 3)
    windows = {f"w{i}": (min(pair), max(pair)) for i, pair in enumerate(windows)}
    lookback = max(oldest for _, oldest in windows.values())
    days = {w: origin + _weeks(w) - timedelta(days=abs(w) % 7) for w in weeks}
    events = spark.createDataFrame([("a", days[w]) for w in weeks], "k string, day date")
    odd = F.dayofyear("day") % 2 == 1
    series = {"any": F.lit(True), "odd": odd}
    histories = with_history(weekly_bitmaps(events, "k", "day", series), "k", list(series))
    last = first + length
    found = flags_per_week(
        histories, "k", "any", ["odd"], windows, origin + _weeks(first), origin + _weeks(last)
    )
    flagged = {w for w, day in days.items() if day.timetuple().tm_yday % 2}
    expected = {
        week: [int(any(week - oldest <= w <= week - newest for w in flagged)) for newest, oldest in windows.values()]
        for week in range(first, last + 1)
        if any(week - lookback <= w <= week for w in weeks)
    }
    rows = found.collect()
    assert len(rows) == len(expected)
    assert {
        (r.week_end_date - origin).days // 7: [r[f"odd_{name}_flag"] for name in windows] for r in rows
    } == expected


def test_spread_weeks_fills_gaps_once(spark):
    w = date(2001, 1, 6)
    own = spark.createDataFrame(
        [("a", w), ("a", w), ("a", w + _weeks(2)), ("a", w + _weeks(9)), ("b", w)], "k string, week date"
    )
    rows = spread_weeks(own, "k", "week", 4, F.lit(w + _weeks(10))).collect()
    found = sorted((r.k, (r.week - w).days // 7) for r in rows)
    assert found == [("a", n) for n in (0, 1, 2, 3, 4, 5, 9, 10)] + [("b", n) for n in range(4)]


def test_flag_in_window_takes_any_window(spark):
    spine = spark.createDataFrame(
        [
            ("a", date(2001, 1, 3), date(2001, 1, 5)),
            ("a", date(2001, 1, 6), date(2001, 1, 9)),
            ("b", date(2001, 1, 1), date(2001, 1, 9)),
        ],
        "k string, lo date, hi date",
    )
    events = spark.createDataFrame(
        [
            ("a", date(2001, 1, 5), 1),
            ("a", date(2001, 1, 5), 1),
            ("a", date(2001, 1, 7), 2),
            ("c", date(2001, 1, 5), 1),
        ],
        "k string, day date, kind int",
    )
    rows = flag_in_window(spine, events, "k", "day", "lo", "hi", "hit", F.col("kind") == 1).collect()
    assert [(r.k, r.lo, r.hit) for r in rows] == [("a", date(2001, 1, 3), 1)]


def test_packed_flags_unpack_to_the_flags_over_several_integers(spark):
    groups = {f"g{n}": (banner,) for n, banner in enumerate(("SOF", "BLF", "QF", "UF", "NM", "PSF"))}
    days = [date(2001, 7, 7) - timedelta(weeks=3 * n) for n in range(9)]
    sales = [sale(day, txn=n, store=1 + n % 5, flag=(IN_STORE, ECOMM)[n % 2]) for n, day in enumerate(days)]
    tables = gold(spark, sales, [(10, "5", "7", "Customer Card", CURRENT)])
    histories = activity.card_histories(tables, WeeklyBounds.of(AS_OF.date()), groups)
    packed = {
        "card_transactions": (activity.packed_card_flags(histories, AS_OF, groups=groups), activity.card_flags(histories, AS_OF, groups=groups)),
        "household_transactions": (
            activity.packed_household_flags(histories, tables.customer_dim, AS_OF, groups=groups),
            activity.household_flags(histories, tables.customer_dim, AS_OF, groups=groups),
        ),
    }
    for name, (narrow, wide) in packed.items():
        assert len(wide.columns) > 36 and len(narrow.columns) == 4
        back = activity.unpacked(narrow, name, AS_OF, groups)
        assert back.dtypes == wide.dtypes and wide.count() > 20
        assert sorted(map(str, back.collect())) == sorted(map(str, wide.collect()))
