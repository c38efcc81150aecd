"""Aggregates by region, month, category, payment method and channel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.measures import period_start
from tallyforge.operators.pivots import pivot_present_values, sums_by_value, sums_in_rows

# The categories of the catalogue and the accepted payment methods.
CATEGORIES = ("clarity", "healing", "invisibility", "love", "luck", "strength")
PAYMENT_METHODS = ("coin", "guild_credit", "crystal_transfer", "barter")
# The channels the mix reports; marketplace is left out.
MIX_CHANNELS = ("in_store", "courier_owl")


def shop_counts(shops: DataFrame) -> DataFrame:
    return shops.groupBy("region").agg(F.count(F.lit(1)).alias("shop_count"))


def revenue_by_region(backfill_orders: DataFrame, shops: DataFrame) -> DataFrame:
    """Region by month over orders of every status, with revenue per shop."""
    rolled = backfill_orders.groupBy("shop_region", "order_month").agg(
        F.countDistinct("order_id").alias("order_count"),
        F.sum("gross_amount_copper").alias("gross_revenue_copper"),
        F.sum("gross_amount_gold").alias("gross_revenue_gold"),
        F.sum("discount_gold").alias("discount_gold"),
        F.count_if(F.col("order_status") == "returned").alias("returned_order_count"),
    )
    counts = shop_counts(shops).withColumnRenamed("region", "shop_region")
    per_shop = F.round(F.col("gross_revenue_gold") / F.nullif(F.col("shop_count"), F.lit(0)), 2)
    return rolled.join(counts, "shop_region", "left").select(
        "shop_region",
        "order_month",
        "shop_count",
        "order_count",
        "gross_revenue_copper",
        "gross_revenue_gold",
        "discount_gold",
        "returned_order_count",
        per_shop.alias("gross_revenue_gold_per_shop"),
    )


def category_revenue_pivot(order_items_fact: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Completed revenue by region and month, one column per category.

    Lines without a listed category count in the total only.
    """
    revenue = F.col("gross_line_amount_gold")
    return (
        order_items_fact.filter(F.col("order_status") == "completed")
        .groupBy("shop_region", period_start(F.col("ordered_at"), "month").alias("order_month"))
        .agg(
            *sums_by_value(categories, F.col("potion_category"), revenue, "revenue_{}_gold", absent=0),
            F.sum(revenue).alias("revenue_total_gold"),
            F.countDistinct("order_id").alias("order_count"),
        )
    )


def category_revenue(order_items_fact: DataFrame) -> DataFrame:
    """Completed revenue by region, month and category in rows, for any number of categories."""
    month = period_start(F.col("ordered_at"), "month").alias("order_month")
    return (
        order_items_fact.filter(F.col("order_status") == "completed")
        .groupBy("shop_region", month, "potion_category")
        .agg(F.sum("gross_line_amount_gold").alias("revenue_gold"), F.count(F.lit(1)).alias("line_count"))
    )


def _paid(orders: DataFrame) -> DataFrame:
    return orders.filter((F.col("order_status") == "completed") & F.col("primary_payment_method").isNotNull())


def payment_method_mix(orders: DataFrame, methods: Sequence[str] = PAYMENT_METHODS) -> DataFrame:
    """Collected gold by region for declared methods; NULL where a method is absent."""
    columns = sums_by_value(methods, F.col("primary_payment_method"), F.col("collected_gold"), "{}")
    return _paid(orders).groupBy("shop_region").agg(*columns)


def payment_method_mix_rows(orders: DataFrame) -> DataFrame:
    """Collected gold by region and method in rows, for any number of methods."""
    return sums_in_rows(_paid(orders), "shop_region", "primary_payment_method", "collected_gold", "collected_gold")


def payment_method_mix_dynamic(orders: DataFrame) -> DataFrame:
    """Collected gold by region, one column per method present in the data."""
    return pivot_present_values(_paid(orders), "shop_region", "primary_payment_method", "collected_gold")


def payment_mix_total(orders: DataFrame, methods: Sequence[str] = PAYMENT_METHODS) -> DataFrame:
    """Collected gold of all orders by region: 0 where a method is absent, plus the total."""
    collected = F.col("collected_gold")
    columns = sums_by_value(
        sorted(methods), F.col("primary_payment_method"), collected, "collected_gold_{}", absent=0
    )
    return orders.groupBy("shop_region").agg(*columns, F.sum(collected).alias("collected_gold_total"))


def channel_mix_labelled(
    orders: DataFrame, item_totals: DataFrame, channels: Sequence[str] = MIX_CHANNELS
) -> DataFrame:
    """Region by month per channel, in one pass over the orders of all channels."""
    totals = item_totals.select("order_id", "gross_amount_gold")
    return channel_mix_of_facts(orders.join(totals, "order_id", "left"), channels)


def channel_mix_of_facts(orders: DataFrame, channels: Sequence[str] = MIX_CHANNELS) -> DataFrame:
    """The same from orders that have their basket amount, such as the order fact."""
    return (
        orders.filter(F.col("channel").isin(*channels))
        .groupBy("channel", "shop_region", period_start(F.col("ordered_at"), "month").alias("order_month"))
        .agg(
            F.sum("gross_amount_gold").alias("gross_revenue_gold"),
            F.countDistinct("order_id").alias("order_count"),
        )
    )


def channel_mix(orders: DataFrame, item_totals: DataFrame, channels: Sequence[str] = MIX_CHANNELS) -> DataFrame:
    """The channels' region-by-month rows stacked without a channel column."""
    return channel_mix_labelled(orders, item_totals, channels).drop("channel")
