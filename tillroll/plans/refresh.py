"""Full refresh of the seven tables: each is rebuilt on its own, from inputs and stored tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field, replace
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.domain import TABLE_PARTITIONS, Settings
from tillroll.functions.calendar import WeeklyBounds
from tillroll.operators import quality
from tillroll.operators.key_filters import key_filters
from tillroll.plans import activity, checks, daily_sales, household_types, shop_dates
from tillroll.sources.footers import deviating_layouts, stored_layouts
from tillroll.sources.published import catalog_folder, publish_version
from tillroll.sources.sinks import full_refresh, scratch, stored
from tillroll.sources.tables import GoldTables, SilverTables, read_table


@dataclass(frozen=True)
class Store:
    """The stored tables below one folder, next to the inputs they are built from.

    ``layout`` names the storage partition column of a table; tables it leaves out are not partitioned.
    Tables that ``databases`` names a database for are catalog tables in versions (``sources/published.py``),
    written below ``versions`` and read by name, so their readers never meet a refresh; the others are
    folders that a refresh replaces.
    """

    gold: GoldTables
    silver: SilverTables
    as_of: datetime
    base: str
    layout: Mapping[str, str] = field(default_factory=lambda: TABLE_PARTITIONS)
    fmt: str = "parquet"
    settings: Settings = Settings()
    databases: Mapping[str, str] = field(default_factory=dict)

    @property
    def spark(self) -> SparkSession:
        return self.gold.customer_dim.sparkSession

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def table(self, name: str) -> DataFrame:
        """A stored table. Storage moves the partition column to the end, so the order is restored;
        columns that are not expected stay visible at the end for the column check to find."""
        published = f"{self.databases[name]}.{name}" if name in self.databases else None
        if published and self.spark.catalog.tableExists(published):
            df = self.spark.table(published)
        else:
            df = read_table(self.spark, self.path(name), fmt=self.fmt)
        expected = [column for column in self.settings.columns[name] if column in df.columns]
        return df.select(*expected, *[column for column in df.columns if column not in expected])

    def deviating_files(self, name: str) -> DataFrame | None:
        """Partitions of a stored table whose files hold other columns than expected; None where the
        files have no footers to tell."""
        if self.fmt != "parquet":
            return None
        folder = catalog_folder(self.spark, f"{self.databases[name]}.{name}") if name in self.databases else self.path(name)
        expected = [column for column in self.settings.columns[name] if column != self.layout.get(name)]
        return deviating_layouts(stored_layouts(self.spark, folder), expected)

    def refresh(self, names: Iterable[str] | None = None) -> dict[str, DataFrame]:
        """Rebuild and store the named tables (all by default), in the order they depend on each other."""
        return {name: self.table(name) for name in self.refresh_counting(names)}

    def refresh_counting(self, names: Iterable[str] | None = None) -> dict[str, dict[str, int]]:
        """``refresh``, and for each table its rows and the violations of its row checks, counted while it
        was written: these checks need not read it again."""
        wanted = set(BUILDERS if names is None else names)
        unknown = wanted - set(BUILDERS)
        if unknown:
            raise ValueError(f"unknown tables: {sorted(unknown)}")
        counts = {}
        with scratch(self.spark) as folder, key_filters(self.spark):
            run = Run(self, folder)
            for name, build in BUILDERS.items():
                if name in wanted:
                    counts[name] = self._store(name, build(run))
        return counts

    def _store(self, name: str, df: DataFrame) -> dict[str, int]:
        observations = []

        def counting(rows: DataFrame) -> DataFrame:
            if name in PACKED:
                rows = activity.unpacked(rows, name, self.as_of, self.settings.banner_groups)
            watched, observation = quality.counting(rows, checks.row_violations(name, self.settings))
            observations.append(observation)
            return watched

        if name in self.databases:
            folder = f"{self.base}/versions/{name}"
            publish_version(df, self.databases[name], name, folder, self.layout.get(name), self.fmt, counting)
        else:
            full_refresh(df, self.path(name), self.layout.get(name), self.fmt, counting)
        return observations[0].get


@dataclass(frozen=True)
class Run:
    """One refresh, and what several of its tables are built from.

    The keys that sales are joined on are stored as narrow tables, so that Spark knows their true
    size when it chooses between sending them to the sales and shuffling the sales. The weekly tables
    share the stored histories of cards, so the facts are read once for both.
    """

    store: Store
    folder: str

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        return stored(df, f"{self.folder}/{name}")

    @cached_property
    def gold(self) -> GoldTables:
        gold = self.store.gold
        items = gold.item_dim.filter(F.col("current_financial_sale_flag") == "Y")
        locations = gold.location_dim.select("location_hk", "current_banner_short_name", "location_type")
        return replace(
            gold,
            item_dim=self._stored(items.select("item_hk", "current_financial_sale_flag"), "items"),
            location_dim=self._stored(locations, "locations"),
        )

    @cached_property
    def current_items(self) -> DataFrame:
        return self._stored(shop_dates.current_items(self.store.silver.item), "current_items")

    @cached_property
    def current_stores(self) -> DataFrame:
        stores = shop_dates.current_stores(self.store.silver.location, self.store.settings.location_types)
        return self._stored(stores, "current_stores")

    @cached_property
    def card_histories(self) -> DataFrame:
        settings, bounds = self.store.settings, WeeklyBounds.of(self.store.as_of.date())
        found = activity.card_histories(self.gold, bounds, settings.banner_groups, settings.location_types)
        return self._stored(found, "card_histories")


def _daily_by_card(run: Run) -> DataFrame:
    return daily_sales.pos_daily_agg_card(run.gold, run.store.as_of, run.store.settings.daily_banners)


def _daily_by_household(run: Run) -> DataFrame:
    store = run.store
    return daily_sales.pos_daily_agg_hhn(store.table("pos_daily_agg_card"), store.gold.customer_dim, store.as_of)


def _shop_dates_by_card(run: Run) -> DataFrame:
    store, settings = run.store, run.store.settings
    return shop_dates.card_shop_dates(
        store.silver, store.as_of, settings.shop_scopes, settings.location_types, run.current_items, run.current_stores
    )


def _shop_dates_by_household(run: Run) -> DataFrame:
    store = run.store
    return shop_dates.household_shop_dates(
        store.table("card_shop_dates"), store.gold.customer_dim, store.as_of, store.settings.shop_scopes
    )


def _activity_by_card(run: Run) -> DataFrame:
    return activity.packed_card_flags(run.card_histories, run.store.as_of, groups=run.store.settings.banner_groups)


def _activity_by_household(run: Run) -> DataFrame:
    store = run.store
    return activity.packed_household_flags(
        run.card_histories, store.gold.customer_dim, store.as_of, groups=store.settings.banner_groups
    )


def _household_type(run: Run) -> DataFrame:
    return household_types.household_type(run.store.gold.customer_dim, run.store.as_of)


# Tables whose builders give packed flags, which become columns at the writer.
PACKED = ("card_transactions", "household_transactions")

# In dependency order: daily sales and shop dates of households are built from the stored card tables.
BUILDERS: dict[str, Callable[[Run], DataFrame]] = {
    "pos_daily_agg_card": _daily_by_card,
    "pos_daily_agg_hhn": _daily_by_household,
    "card_shop_dates": _shop_dates_by_card,
    "household_shop_dates": _shop_dates_by_household,
    "card_transactions": _activity_by_card,
    "household_transactions": _activity_by_household,
    "household_type": _household_type,
}
