"""Assembly: every model over one set of raw tables."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from datetime import datetime, timedelta
from functools import wraps
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions.audit import with_audit_columns
from tallyforge.operators.checks import Check, run_checks
from tallyforge.operators.followed import FollowedChecks
from tallyforge.operators.history import history_partition, insert_snapshot, take_snapshot
from tallyforge.operators.pivots import discover_values
from tallyforge.operators.rollups import MaintainedRollup
from tallyforge.operators.skew import ROW_BYTES, HotKeys, hot_keys, spread_join
from tallyforge.plans import aggregates, dimensions, facts, staging
from tallyforge.plans.quality import CHECKS
from tallyforge.settings import Settings
from tallyforge.sources.colocated import ColocatedTables, buckets_for
from tallyforge.sources.published import PublishedTable, audited_publish, month_partition
from tallyforge.sources.storage import materialize, tree_bytes
from tallyforge.streaming.drops import load_drops
from tallyforge.streaming.incremental import high_water_mark, load, possibly_newer


class RawTables(Protocol):
    """Where the raw extracts come from; ``source_paths`` is empty where files are unknown."""

    spark: SparkSession

    def table(self, name: str) -> DataFrame: ...

    def source_paths(self, name: str) -> list[str]: ...


# Join keys of each raw table that more than one row may share.
FOREIGN_KEYS: dict[str, tuple[str, ...]] = {
    "raw_orders": ("customer_id", "shop_id"),
    "raw_order_items": ("order_id", "potion_sku"),
    "raw_potion_ingredients": ("ingredient_id",),
    "raw_brew_events": ("potion_sku",),
    "raw_guild_memberships": ("customer_id", "guild_id"),
}

#: File bytes of a raw table whose keys one task counts in a check.
CHECK_BYTES = 16 << 20


def _once(build: Callable[[RetailMarts], DataFrame]) -> Callable[[RetailMarts], DataFrame]:
    """Build a staging plan once per assembly; models that share it share the plan, not its rows."""

    @wraps(build)
    def staged(self: RetailMarts) -> DataFrame:
        if build.__name__ not in self._staged:
            self._staged[build.__name__] = build(self)
        return self._staged[build.__name__]

    return staged


class RetailMarts:
    """Lazy models over raw tables as they are when the object is made; a call builds a plan.

    A model pulls in only the inputs whose columns it uses: the payment mix, for one, joins
    neither customers nor order lines.
    """

    def __init__(self, raw: RawTables, settings: Settings | None = None) -> None:
        self.raw, self.spark = raw, raw.spark
        self.settings = settings or Settings()
        self._profiles: dict[str, dict[str, HotKeys]] = {}
        self._sizes: dict[str, float] = {}
        self._staged: dict[str, DataFrame] = {}

    def _hot(self, table: str, column: str, lookup: str) -> HotKeys | None:
        """Hot values of a join key; None where the lookup is broadcast.

        Profiling a table of several tasks runs one pass over its keys when a model that joins it
        is first built; a smaller table cannot have hot keys.
        """
        if self._bytes(lookup) <= self.settings.broadcast_bytes:
            return None
        if table not in self._profiles:
            found = hot_keys(
                self.raw.table(table), FOREIGN_KEYS[table], self._bytes(table), self.settings.task_bytes
            )
            self._profiles[table] = {hot.column: hot for hot in found}
        return self._profiles[table][column]

    def _lookup(self, table: str, df: DataFrame) -> DataFrame:
        """The staged table as a join side: broadcast when its files are small, else as it is."""
        return F.broadcast(df) if self._bytes(table) <= self.settings.broadcast_bytes else df

    def _bytes(self, table: str) -> float:
        """Size of a raw table's files; infinite when it cannot be told."""
        if table not in self._sizes:
            sizes = [tree_bytes(self.spark, path) for path in self.raw.source_paths(table)]
            self._sizes[table] = sum(sizes) if sizes and all(sizes) else math.inf
        return self._sizes[table]

    def _known_bytes(self, table: str) -> float:
        """The same; rows count as ``ROW_BYTES`` each when it cannot be told."""
        size = self._bytes(table)
        return self.raw.table(table).count() * ROW_BYTES if math.isinf(size) else size

    # Staging

    @_once
    def stg_orders(self) -> DataFrame:
        return staging.orders(self.raw.table("raw_orders"), self.settings)

    @_once
    def stg_order_items(self) -> DataFrame:
        return staging.order_items(self.raw.table("raw_order_items"), self.settings)

    @_once
    def stg_payments(self) -> DataFrame:
        return staging.payments(self.raw.table("raw_payments"), self.settings)

    @_once
    def stg_potions(self) -> DataFrame:
        return staging.potions(self.raw.table("raw_potions"), self.settings)

    @_once
    def stg_shops(self) -> DataFrame:
        return staging.shops(self.raw.table("raw_shops"))

    @_once
    def stg_suppliers(self) -> DataFrame:
        return staging.suppliers(self.raw.table("raw_suppliers"))

    @_once
    def stg_ingredients(self) -> DataFrame:
        return staging.ingredients(self.raw.table("raw_ingredients"), self.settings)

    @_once
    def stg_potion_ingredients(self) -> DataFrame:
        return staging.potion_ingredients(self.raw.table("raw_potion_ingredients"))

    @_once
    def stg_brew_events(self) -> DataFrame:
        return staging.brew_events(self.raw.table("raw_brew_events"))

    @_once
    def stg_customers(self) -> DataFrame:
        return staging.customers(self.raw.table("raw_customers"))

    @_once
    def stg_guilds(self) -> DataFrame:
        return staging.guilds(self.raw.table("raw_guilds"))

    @_once
    def stg_guild_memberships(self) -> DataFrame:
        return staging.guild_memberships(self.raw.table("raw_guild_memberships"))

    # Intermediate

    def order_item_totals(self) -> DataFrame:
        return facts.order_item_totals(self.stg_order_items(), self.settings)

    def order_payments(self) -> DataFrame:
        return facts.order_payments(self.stg_payments(), self.settings)

    def orders_with_shops(self) -> DataFrame:
        hot = self._hot("raw_orders", "shop_id", "raw_shops")
        return facts.with_shops(self.stg_orders(), self._lookup("raw_shops", self.stg_shops()), hot)

    def orders_enriched(self) -> DataFrame:
        return facts.orders_enriched(
            self.stg_orders(),
            self._lookup("raw_shops", self.stg_shops()),
            self._lookup("raw_customers", self.stg_customers()),
            self._hot("raw_orders", "shop_id", "raw_shops"),
            self._hot("raw_orders", "customer_id", "raw_customers"),
        )

    def orders_with_outcome(self) -> DataFrame:
        """Orders with shop and payment outcome: what the payment mixes read of the order fact."""
        return facts.with_payments(self.orders_with_shops(), self.order_payments())

    # Facts

    def fct_orders(self) -> DataFrame:
        return facts.fct_orders(
            self.orders_enriched(), self.order_item_totals(), self.order_payments(), self.settings
        )

    def fct_orders_audited(self) -> DataFrame:
        return with_audit_columns(self.fct_orders(), self.settings.run_id)

    def fct_order_items(self) -> DataFrame:
        hot_orders = self._hot("raw_order_items", "order_id", "raw_orders")
        hot_potions = self._hot("raw_order_items", "potion_sku", "raw_potions")
        lines, spread = self.stg_order_items(), None
        if hot_orders or hot_potions:
            # A position within the scanned file split also tells exact copies of a line apart.
            lines = lines.withColumn("line_position", F.monotonically_increasing_id())
            spread = F.col("line_position")
        potions = self._lookup("raw_potions", self.stg_potions())
        return facts.fct_order_items(
            lines, self.orders_with_shops(), potions, self.settings, hot_orders, hot_potions, spread
        )

    def order_grain_buckets(self) -> int:
        """Buckets for what joins on the order, so that one holds no more of a larger table."""
        return buckets_for(max(map(self._known_bytes, ("raw_orders", "raw_order_items", "raw_payments"))))

    def publish_order_grain(self, tables: ColocatedTables) -> None:
        """Store what joins on the order bucketed by it: enriched orders, both rollups, and the lines."""
        tables.publish("orders", self.orders_enriched())
        tables.publish("item_totals", self.order_item_totals())
        tables.publish("payments", self.order_payments())
        tables.publish("lines", self.stg_order_items())

    def fct_orders_colocated(self, tables: ColocatedTables) -> DataFrame:
        """The order fact from stored tables, without moving a row."""
        return facts.fct_orders(tables.read("orders"), tables.read("item_totals"), tables.read("payments"), self.settings)

    def fct_order_items_colocated(self, tables: ColocatedTables) -> DataFrame:
        """The line fact from stored tables; only the join with the potions may move rows."""
        potions = self._lookup("raw_potions", self.stg_potions())
        return facts.fct_order_items(tables.read("lines"), tables.read("orders"), potions, self.settings)

    def orders_backfill(self) -> DataFrame:
        return facts.orders_backfill(self.orders_with_shops(), self.order_item_totals(), self.settings)

    def publish_orders_backfill(self, table: PublishedTable, orders: DataFrame | None = None) -> DataFrame:
        """The slim order fact: stored in standard mode, a plan only during a backfill.

        It is cut out of the published order facts when they are given.
        """
        rows = self.orders_backfill() if orders is None else facts.slim_orders(orders, self.settings)
        if self.settings.run_mode == "backfill":
            return rows
        table.replace(rows)
        return table.read()

    def regulated_sales(self) -> DataFrame:
        return facts.regulated_sales(self.fct_order_items())

    def load_payment_texts(self, table: PublishedTable, lookback: timedelta = timedelta(0)) -> None:
        """The same run for a feed with text times: the window reaches the scan as a text filter."""
        mark = high_water_mark(table, "paid_at") if table.exists() else None
        raw = possibly_newer(self.raw.table("raw_payments"), "paid_at", mark, lookback)
        load(table, staging.payments(raw, self.settings), "paid_at", ["payment_id"], lookback)

    def publish_regulated_sales(
        self, table: PublishedTable, ledger_path: str, rows: DataFrame | None = None, checks: Sequence[Check] = ()
    ) -> DataFrame:
        """Publish the regulated sales, if they pass ``checks``, and return the build ledger."""
        name = table.relation.rpartition(".")[2]
        failures = (lambda staged: run_checks({name: staged}, {name: checks})) if checks else None
        rows = self.regulated_sales() if rows is None else rows
        return audited_publish(rows, table, ledger_path, self.settings.run_id, "guild-audit-team", failures)

    def order_payments_rollup(self, payments: PublishedTable, path: str) -> MaintainedRollup:
        """The payment attempts per order, kept up to date from the changes of the published payments."""
        return facts.order_payments_rollup(payments, path)

    def payment_checks(self, payments: PublishedTable, path: str) -> FollowedChecks:
        """The checks of the staged payments, following the published ones."""
        return FollowedChecks("fct_payment_events", payments, CHECKS["stg_payments"], path)

    def load_payment_drops(self, table: PublishedTable, folder: str, checkpoint: str, **options) -> None:
        """Merge the Parquet files of raw payments that landed in a folder since the last run."""
        schema = self.raw.table("raw_payments").schema
        stage = lambda raw: staging.payments(raw, self.settings)
        load_drops(
            self.spark, folder, schema, "parquet", stage, table, checkpoint, ["payment_id"], "paid_at", **options
        )

    def payment_events_table(self, path: str) -> PublishedTable:
        return PublishedTable(
            self.spark, path, month_partition("paid_at"), keys=["payment_id"], ordered_by="paid_at"
        )

    def load_payment_events(
        self, table: PublishedTable, lookback: timedelta = timedelta(0), full_refresh: bool = False
    ) -> None:
        """One incremental run of the payment attempts, keyed by payment."""
        load(table, self.stg_payments(), "paid_at", ["payment_id"], lookback, full_refresh)

    def brew_yield(self) -> DataFrame:
        hot = self._hot("raw_brew_events", "potion_sku", "raw_potions")
        potions = self._lookup("raw_potions", self.stg_potions())
        return facts.brew_yield(self.stg_brew_events(), potions, hot)

    def priced_lines(self) -> DataFrame:
        """Order lines with their potion's list price."""
        listed = self.stg_potions().select("potion_sku", "base_price_copper")
        hot = self._hot("raw_order_items", "potion_sku", "raw_potions")
        potions = self._lookup("raw_potions", listed)
        return spread_join(
            self.stg_order_items(), potions, "potion_sku", "left", hot, F.monotonically_increasing_id()
        )

    # Dimensions

    def current_membership(self) -> DataFrame:
        return self.customer_memberships().drop("membership_id")

    def customer_memberships(self) -> DataFrame:
        """Current memberships with their ids."""
        hot = self._hot("raw_guild_memberships", "guild_id", "raw_guilds")
        guilds = self._lookup("raw_guilds", self.stg_guilds())
        return dimensions.open_memberships(self.stg_guild_memberships(), guilds, hot)

    def customer_activity(self) -> DataFrame:
        return dimensions.customer_activity(facts.with_payments(self.stg_orders(), self.order_payments()))

    def dim_customers(self, orders: DataFrame | None = None) -> DataFrame:
        """The customer dimension, from published order facts when they are given."""
        activity = self.customer_activity() if orders is None else dimensions.customer_activity(orders)
        hot = self._hot("raw_guild_memberships", "customer_id", "raw_customers")
        return dimensions.dim_customers(self.stg_customers(), self.customer_memberships(), activity, hot)

    def recipe_cost(self) -> DataFrame:
        hot = self._hot("raw_potion_ingredients", "ingredient_id", "raw_ingredients")
        ingredients = self._lookup("raw_ingredients", self.stg_ingredients())
        return dimensions.recipe_cost(self.stg_potion_ingredients(), ingredients, hot)

    def brew_stats(self) -> DataFrame:
        return dimensions.brew_stats(self.stg_brew_events())

    def dim_potions(self) -> DataFrame:
        return dimensions.dim_potions(
            self.stg_potions(), self.recipe_cost(), self.brew_stats(), self.settings
        )

    def supplier_scorecard(self) -> DataFrame:
        return dimensions.supplier_scorecard(self.stg_suppliers(), self.stg_ingredients())

    def insert_membership_snapshot(self, table: PublishedTable, at: datetime, memberships: DataFrame) -> None:
        """Work an extract as of ``at`` into the membership history, wherever its time falls."""
        insert_snapshot(table, memberships, "membership_id", ["tier", "guild_id", "valid_to"], at)

    def snapshot_memberships(self, table: PublishedTable, at: datetime, memberships: DataFrame | None = None) -> None:
        """Record membership versions as of ``at``."""
        source = self.stg_guild_memberships() if memberships is None else memberships
        take_snapshot(table, source, "membership_id", ["tier", "guild_id", "valid_to"], at)

    def memberships_history_table(self, path: str) -> PublishedTable:
        return PublishedTable(self.spark, path, history_partition("membership_id"), keys=["membership_id"])

    # Aggregates

    def shop_counts(self) -> DataFrame:
        return aggregates.shop_counts(self.stg_shops())

    def revenue_by_region(self) -> DataFrame:
        return aggregates.revenue_by_region(self.orders_backfill(), self.stg_shops())

    def category_revenue_pivot(self) -> DataFrame:
        categories = discover_values(self.stg_potions(), "category", aggregates.CATEGORIES)
        return aggregates.category_revenue_pivot(self.fct_order_items(), categories)

    def category_revenue(self) -> DataFrame:
        return aggregates.category_revenue(self.fct_order_items())

    def payment_method_mix(self) -> DataFrame:
        return aggregates.payment_method_mix(self.orders_with_outcome())

    def payment_method_mix_rows(self) -> DataFrame:
        return aggregates.payment_method_mix_rows(self.orders_with_outcome())

    def payment_method_mix_dynamic(self) -> DataFrame:
        return aggregates.payment_method_mix_dynamic(self.orders_with_outcome())

    def payment_mix_total(self) -> DataFrame:
        return aggregates.payment_mix_total(self.orders_with_outcome())

    def channel_mix(self) -> DataFrame:
        return aggregates.channel_mix(self.orders_with_shops(), self.order_item_totals())

    def channel_mix_labelled(self) -> DataFrame:
        return aggregates.channel_mix_labelled(self.orders_with_shops(), self.order_item_totals())

    # Checks

    def check_tasks(self) -> dict[str, int]:
        """Tasks for the checks of the recipes, which may come out of a grouping of all lines."""
        size = self._known_bytes("raw_potion_ingredients")
        return {"stg_potion_ingredients": math.ceil(size / CHECK_BYTES)}

    def check_all(self) -> DataFrame:
        """All declared checks, one row each; the two facts are worked out and written once."""
        orders, lines = materialize(self.fct_orders()), materialize(self.fct_order_items())
        tables = {
            "fct_orders": orders,
            "fct_order_items": lines,
            "dim_customers": self.dim_customers(orders),
            "dim_potions": self.dim_potions(),
            "agg_revenue_by_region": aggregates.revenue_by_region(
                facts.slim_orders(orders, self.settings), self.stg_shops()
            ),
        }
        staged = {name: getattr(self, name)() for name in CHECKS if name.startswith("stg_")}
        return run_checks({**tables, **staged}, CHECKS, self.check_tasks())
