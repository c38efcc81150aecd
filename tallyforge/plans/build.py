"""The full build: every mart published, in dependency order, then checked."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tallyforge.functions.audit import with_audit_columns
from tallyforge.operators.checks import run_checks
from tallyforge.operators.pivots import discover_values
from tallyforge.plans import aggregates, dimensions, facts
from tallyforge.plans.marts import RetailMarts
from tallyforge.plans.quality import CHECKS
from tallyforge.sources.published import PublishedTable, audited_publish

LEDGER = "build_ledger"


def _side_by_side(spark: SparkSession, *chains: Callable[[], None]) -> None:
    """Run chains of publishes that need nothing of each other, so that one's tasks fill the cores that another's last ones leave.

    All run to their end; then the first error is raised.
    """
    with ThreadPoolExecutor(len(chains)) as pool:
        # Scratch owners are context variables, job groups and descriptions are properties of the session's thread.
        runs = [pool.submit(copy_context().run, inheritable_thread_target(spark)(chain)) for chain in chains]
    for run in runs:
        run.result()


def build(marts: RetailMarts, root: str, at: datetime, shelved: bool = False) -> dict[str, PublishedTable]:
    """Publish the marts under ``root``; each reads the published tables it builds on.

    Payment events load incrementally and membership history advances to ``at``; the rest is
    rebuilt. ``shelved`` adds the three models that are off by default. Marts that need nothing of
    each other are published side by side.
    """
    root, run_id = root.rstrip("/"), marts.settings.run_id
    tables: dict[str, PublishedTable] = {}

    def publish(name: str, df: DataFrame) -> DataFrame:
        tables[name] = PublishedTable(marts.spark, f"{root}/{name}")
        tables[name].replace(df)
        return tables[name].read()

    def from_orders() -> None:
        orders = publish("fct_orders", with_audit_columns(marts.fct_orders(), run_id))
        publish("dim_customers", with_audit_columns(marts.dim_customers(orders), run_id))

        backfill_table = PublishedTable(marts.spark, f"{root}/fct_orders_backfill")
        backfill = marts.publish_orders_backfill(backfill_table, orders)
        if backfill_table.exists():
            tables["fct_orders_backfill"] = backfill_table
        revenue = aggregates.revenue_by_region(backfill, marts.stg_shops())
        publish("agg_revenue_by_region", with_audit_columns(revenue, run_id))

        publish("agg_payment_method_mix", aggregates.payment_method_mix(orders))
        if shelved:
            publish("agg_shop_channel_mix", aggregates.channel_mix_of_facts(orders).drop("channel"))

    def from_lines() -> None:
        lines = publish("fct_order_items", marts.fct_order_items())
        categories = discover_values(marts.stg_potions(), "category", aggregates.CATEGORIES)
        publish("agg_category_revenue_pivot", aggregates.category_revenue_pivot(lines, categories))

        regulated = tables["fct_regulated_sales"] = PublishedTable(
            marts.spark, f"{root}/fct_regulated_sales", relation=f"{root.rpartition('/')[2]}.fct_regulated_sales"
        )
        audited_publish(facts.regulated_sales(lines), regulated, f"{root}/{LEDGER}", run_id, "guild-audit-team")

    def from_recipes() -> None:
        publish("dim_potions", with_audit_columns(marts.dim_potions(), run_id))

    def loaded() -> None:
        events = tables["fct_payment_events"] = marts.payment_events_table(f"{root}/fct_payment_events")
        marts.load_payment_events(events)
        history = tables["membership_history"] = marts.memberships_history_table(f"{root}/membership_history")
        marts.snapshot_memberships(history, at)
        if shelved:
            scorecard = dimensions.supplier_scorecard(marts.stg_suppliers(), marts.stg_ingredients())
            publish("dim_supplier_scorecard", scorecard)
            publish("fct_brew_yield", marts.brew_yield())

    _side_by_side(marts.spark, from_orders, from_lines, from_recipes, loaded)
    return tables


def check_build(marts: RetailMarts, tables: dict[str, PublishedTable]) -> DataFrame:
    """All declared checks, the marts' on their published tables."""
    checked = {name: tables[name].read() if name in tables else getattr(marts, name)() for name in CHECKS}
    return run_checks(checked, CHECKS, marts.check_tasks())
