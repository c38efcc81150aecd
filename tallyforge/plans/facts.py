"""Order, line, payment and production facts, and the rollups and joins they are made of.

Customers, shops, potions and ingredients have unique keys (the checks guard that), so a
model that reads none of a dimension's columns leaves its join out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.measures import copper_to_gold, is_weekend, period_start, safe_divide
from tallyforge.operators.rollups import MaintainedRollup
from tallyforge.operators.skew import HotKeys, spread_join
from tallyforge.plans.staging import line_amounts
from tallyforge.settings import Settings
from tallyforge.sources.published import PublishedTable


def order_item_totals(order_items: DataFrame, settings: Settings) -> DataFrame:
    """Lines rolled up to one row per order. Copper is summed first, then converted."""
    totals = order_items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("gross_line_amount_copper").alias("gross_amount_copper"),
    )
    gold = copper_to_gold(F.col("gross_amount_copper"), settings.copper_per_gold)
    return totals.withColumn("gross_amount_gold", gold)


def order_payments(payments: DataFrame, settings: Settings) -> DataFrame:
    """Payment attempts rolled up to one row per order; only successes count as collected."""
    amount, status = F.col("amount_copper"), F.col("payment_status")
    rolled = payments.groupBy("order_id").agg(
        F.sum(F.when(status == "success", amount).otherwise(0)).alias("collected_copper"),
        F.sum(F.when(status == "refunded", amount).otherwise(0)).alias("refunded_copper"),
        F.count(F.lit(1)).alias("payment_attempt_count"),
        F.count_if(status == "failed").alias("failed_payment_count"),
        F.max("paid_at").alias("last_payment_at"),
        F.min(F.when(status == "success", F.col("payment_method"))).alias("primary_payment_method"),
    )
    return with_payment_gold(rolled, settings)


def order_payments_rollup(payments: PublishedTable, path: str) -> MaintainedRollup:
    """The same rollup of published payments, stored under ``path`` and kept up to date."""
    amount, status = F.col("amount_copper"), F.col("payment_status")
    return MaintainedRollup(
        payments,
        path,
        ["order_id"],
        {
            "collected_copper": F.when(status == "success", amount).otherwise(0),
            "refunded_copper": F.when(status == "refunded", amount).otherwise(0),
            "failed_payment_count": F.when(status == "failed", 1).otherwise(0),
        },
        least={"primary_payment_method": F.when(status == "success", F.col("payment_method"))},
        most={"last_payment_at": F.col("paid_at")},
    )


def with_payment_gold(rolled: DataFrame, settings: Settings) -> DataFrame:
    """Payments per order with their amounts in gold."""
    rate = settings.copper_per_gold
    return rolled.select(
        "order_id",
        "collected_copper",
        copper_to_gold(F.col("collected_copper"), rate).alias("collected_gold"),
        "refunded_copper",
        copper_to_gold(F.col("refunded_copper"), rate).alias("refunded_gold"),
        "payment_attempt_count",
        "failed_payment_count",
        "last_payment_at",
        "primary_payment_method",
    )


def with_shops(orders: DataFrame, shops: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Orders widened with their shop's name, region and city."""
    named = shops.select(
        "shop_id", "shop_name", F.col("region").alias("shop_region"), F.col("city").alias("shop_city")
    )
    return spread_join(orders, named, "shop_id", "left", hot, F.xxhash64("order_id"))


def with_customers(orders: DataFrame, customers: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Orders widened with their customer's name, home region and discipline."""
    named = customers.select(
        "customer_id",
        F.col("full_name").alias("customer_name"),
        F.col("home_region").alias("customer_home_region"),
        "favored_discipline",
    )
    return spread_join(orders, named, "customer_id", "left", hot, F.xxhash64("order_id"))


def orders_enriched(
    orders: DataFrame,
    shops: DataFrame,
    customers: DataFrame,
    hot_shops: HotKeys | None = None,
    hot_customers: HotKeys | None = None,
) -> DataFrame:
    """Order header with shop and customer attributes."""
    return with_customers(with_shops(orders, shops, hot_shops), customers, hot_customers).select(
        "order_id",
        "customer_id",
        "shop_id",
        "ordered_at",
        "order_status",
        "channel",
        "discount_copper",
        "discount_gold",
        "shop_name",
        "shop_region",
        "shop_city",
        "customer_name",
        "customer_home_region",
        "favored_discipline",
    )


def with_payments(orders: DataFrame, payments_rolled: DataFrame) -> DataFrame:
    """Orders with their payment outcome; orders never paid for count as zero."""
    counted = (
        "collected_copper",
        "collected_gold",
        "refunded_gold",
        "payment_attempt_count",
        "failed_payment_count",
    )
    kept = payments_rolled.select("order_id", *counted, "primary_payment_method", "last_payment_at")
    return orders.join(kept, "order_id", "left").withColumns(
        {name: F.coalesce(F.col(name), F.lit(0).cast(kept.schema[name].dataType)) for name in counted}
    )


def fct_orders(
    enriched: DataFrame, item_totals: DataFrame, payments_rolled: DataFrame, settings: Settings
) -> DataFrame:
    """One row per order with basket and payment metrics.

    The net amount is gross less discount, converted as a whole. Orders without lines keep
    NULL basket columns.
    """
    net = F.col("gross_amount_copper") - F.col("discount_copper")
    return with_payments(enriched.join(item_totals, "order_id", "left"), payments_rolled).select(
        "order_id",
        "customer_id",
        "shop_id",
        "ordered_at",
        "order_status",
        "channel",
        is_weekend(F.col("ordered_at")).alias("is_weekend_order"),
        "shop_name",
        "shop_region",
        "customer_name",
        "line_count",
        "total_quantity",
        "gross_amount_copper",
        "gross_amount_gold",
        "discount_copper",
        net.alias("net_amount_copper"),
        copper_to_gold(net, settings.copper_per_gold).alias("net_amount_gold"),
        "collected_copper",
        "collected_gold",
        "refunded_gold",
        "payment_attempt_count",
        "failed_payment_count",
        "primary_payment_method",
        "last_payment_at",
    )


def fct_order_items(
    order_items: DataFrame,
    orders: DataFrame,
    potions: DataFrame,
    settings: Settings,
    hot_orders: HotKeys | None = None,
    hot_potions: HotKeys | None = None,
    spread: Column | None = None,
) -> DataFrame:
    """One row per order line, with order and potion attributes.

    ``orders`` needs the shop's region. Amounts are worked out again after the joins, so that
    they are not shuffled. ``spread`` distributes the lines of a hot order or potion; it
    defaults to the line id.
    """
    spread = F.xxhash64("order_item_id") if spread is None else spread
    derived = ("unit_price_gold", "gross_line_amount_copper", "gross_line_amount_gold")
    headers = orders.select(
        "order_id", "customer_id", "shop_id", "shop_region", "ordered_at", "order_status"
    )
    catalogue = potions.select(
        "potion_sku", "potion_name", F.col("category").alias("potion_category"), "is_regulated"
    )
    lines = spread_join(order_items.drop(*derived), headers, "order_id", "inner", hot_orders, spread)
    return spread_join(lines, catalogue, "potion_sku", "left", hot_potions, spread).select(
        "order_item_id",
        "order_id",
        "potion_sku",
        "customer_id",
        "shop_id",
        "shop_region",
        "ordered_at",
        "order_status",
        "potion_name",
        "potion_category",
        "is_regulated",
        "quantity",
        "unit_price_copper",
        *line_amounts(settings),
    )


def orders_backfill(orders: DataFrame, item_totals: DataFrame, settings: Settings) -> DataFrame:
    """Slim order fact with its month and the run mode; ``orders`` needs the shop's region."""
    totals = item_totals.select("order_id", "gross_amount_copper", "gross_amount_gold")
    return orders.join(totals, "order_id", "left").select(
        "order_id",
        "shop_region",
        "channel",
        "order_status",
        "ordered_at",
        period_start(F.col("ordered_at"), "month").alias("order_month"),
        "gross_amount_copper",
        "gross_amount_gold",
        "discount_gold",
        F.lit(settings.run_mode).alias("pipeline_run_mode"),
    )


def slim_orders(orders: DataFrame, settings: Settings) -> DataFrame:
    """The same slim fact, cut out of the order fact."""
    return orders.select(
        "order_id",
        "shop_region",
        "channel",
        "order_status",
        "ordered_at",
        period_start(F.col("ordered_at"), "month").alias("order_month"),
        "gross_amount_copper",
        "gross_amount_gold",
        copper_to_gold(F.col("discount_copper"), settings.copper_per_gold).alias("discount_gold"),
        F.lit(settings.run_mode).alias("pipeline_run_mode"),
    )


def regulated_sales(order_items_fact: DataFrame) -> DataFrame:
    """Completed sales of regulated potions, with the reporting quarter."""
    kept = order_items_fact.filter(F.col("is_regulated") & (F.col("order_status") == "completed")).select(
        "order_item_id",
        "order_id",
        "potion_sku",
        "potion_name",
        "potion_category",
        "customer_id",
        "shop_id",
        "shop_region",
        "ordered_at",
        "quantity",
        "unit_price_gold",
        "gross_line_amount_gold",
    )
    return kept.select("*", period_start(F.col("ordered_at"), "quarter").alias("reporting_quarter"))


def brew_yield(brew_events: DataFrame, potions: DataFrame, hot_potions: HotKeys | None = None) -> DataFrame:
    """Yield rate and finish time of each batch of a potion in the catalogue."""
    known = spread_join(
        brew_events, potions.select("potion_sku"), "potion_sku", "inner", hot_potions, F.xxhash64("brew_id")
    )
    minutes = F.col("brew_duration_minutes")
    return known.select(
        "brew_id",
        "potion_sku",
        "shop_id",
        "cauldron_id",
        "brewed_at",
        "batch_size",
        "brew_duration_minutes",
        "quality_check",
        safe_divide(F.col("batch_size"), minutes).alias("units_per_minute"),
        F.timestamp_add("MINUTE", minutes, F.col("brewed_at")).alias("brew_finished_at"),
    )
