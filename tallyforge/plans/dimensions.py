"""Customer, potion and supplier dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.measures import copper_to_gold, exact_avg, safe_divide
from tallyforge.operators.skew import HotKeys, spread_join, spread_left_join
from tallyforge.settings import Settings

# Lifetime collected gold from which a customer belongs to a segment.
SEGMENTS = (("archmage", 500), ("adept", 150))


def open_memberships(memberships: DataFrame, guilds: DataFrame, hot_guilds: HotKeys | None = None) -> DataFrame:
    """Open memberships with their guild. A customer with two open rows keeps both."""
    current = memberships.filter("is_current_membership")
    named = guilds.select("guild_id", "guild_name")
    return spread_join(current, named, "guild_id", "inner", hot_guilds, F.xxhash64("membership_id")).select(
        "membership_id", "customer_id", "guild_id", "tier", "guild_name", F.col("valid_from").alias("tier_since")
    )


def customer_activity(orders: DataFrame) -> DataFrame:
    """Completed orders rolled up per customer; ``orders`` needs the payment outcome."""
    return (
        orders.filter(F.col("order_status") == "completed")
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("lifetime_order_count"),
            F.sum("collected_gold").alias("lifetime_collected_gold"),
            F.min("ordered_at").alias("first_order_at"),
            F.max("ordered_at").alias("most_recent_order_at"),
        )
    )


def dim_customers(
    customers: DataFrame, membership: DataFrame, activity: DataFrame, hot_members: HotKeys | None = None
) -> DataFrame:
    """Customer with current guild standing, lifetime activity and value segment.

    One row per customer and open membership; the uniqueness check reports a customer with
    several. Rows of a customer with very many are told apart by ``membership_id``.
    """
    standing = membership.select(
        "membership_id",
        "customer_id",
        "guild_id",
        "guild_name",
        F.col("tier").alias("guild_tier"),
        F.col("tier_since").alias("guild_tier_since"),
    )
    spent = F.col("lifetime_collected_gold")
    (top, top_from), (middle, middle_from) = SEGMENTS
    segment = (
        F.when(spent >= top_from, top).when(spent >= middle_from, middle).when(spent > 0, "apprentice").otherwise("prospect")
    )
    known = customers.join(activity, "customer_id", "left")
    return spread_left_join(known, standing, "customer_id", hot_members, F.xxhash64("membership_id")).select(
        "customer_id",
        "full_name",
        "email",
        "home_region",
        "signed_up_at",
        "birth_year",
        "favored_discipline",
        "guild_id",
        "guild_name",
        "guild_tier",
        "guild_tier_since",
        F.coalesce("lifetime_order_count", F.lit(0)).alias("lifetime_order_count"),
        F.coalesce(spent, F.lit(0).cast("decimal(28,2)")).alias("lifetime_collected_gold"),
        "first_order_at",
        "most_recent_order_at",
        segment.alias("value_segment"),
    )


def recipe_cost(recipes: DataFrame, ingredients: DataFrame, hot_ingredients: HotKeys | None = None) -> DataFrame:
    """Ingredient count, cost and hazard flag per potion."""
    priced = spread_join(
        recipes.select("potion_sku", "ingredient_id", "quantity"),
        ingredients.select("ingredient_id", "unit_cost_copper", "is_hazardous"),
        "ingredient_id",
        "inner",
        hot_ingredients,
        F.xxhash64("potion_sku"),
    )
    hazardous = F.max(F.when(F.col("is_hazardous"), 1).otherwise(0)) == 1
    return priced.groupBy("potion_sku").agg(
        F.count(F.lit(1)).alias("ingredient_count"),
        F.sum(F.col("quantity") * F.col("unit_cost_copper")).alias("recipe_cost_copper"),
        hazardous.alias("has_hazardous_ingredient"),
    )


def brew_stats(brew_events: DataFrame) -> DataFrame:
    """Batch count, units, mean duration and failure share per potion.

    Batches without a quality outcome stay in the denominator.
    """
    failed = F.count_if(F.col("quality_check") == "fail")
    return brew_events.groupBy("potion_sku").agg(
        F.count(F.lit(1)).alias("brew_event_count"),
        F.sum("batch_size").alias("total_units_brewed"),
        F.avg("brew_duration_minutes").alias("avg_brew_duration_minutes"),
        safe_divide(failed, F.count(F.lit(1)).cast("double")).alias("brew_failure_rate"),
    )


def dim_potions(potions: DataFrame, costs: DataFrame, stats: DataFrame, settings: Settings) -> DataFrame:
    """Potion with recipe cost, unit margin and brew quality."""
    base = F.col("base_price_copper")
    margin = base - F.col("recipe_cost_copper")
    return (
        potions.join(costs, "potion_sku", "left")
        .join(stats, "potion_sku", "left")
        .select(
            "potion_sku",
            "potion_name",
            "category",
            "potency",
            "shelf_life_days",
            "is_regulated",
            "introduced_at",
            "base_price_copper",
            "base_price_gold",
            "ingredient_count",
            "recipe_cost_copper",
            copper_to_gold(F.col("recipe_cost_copper"), settings.copper_per_gold).alias("recipe_cost_gold"),
            "has_hazardous_ingredient",
            margin.alias("unit_margin_copper"),
            F.round(margin / F.nullif(base, F.lit(0)).cast("double"), 4).alias("unit_margin_pct"),
            "brew_event_count",
            "total_units_brewed",
            "avg_brew_duration_minutes",
            "brew_failure_rate",
        )
    )


def supplier_scorecard(suppliers: DataFrame, ingredients: DataFrame) -> DataFrame:
    """Supplier with ingredient count, mean cost and hazardous count; zero when it has none.

    Ingredients are rolled up per supplier before the join, so a supplier of very many meets
    the join as one row. Exact copies of a supplier row form one group and count its
    ingredients once per copy, as grouping after the join would.
    """
    described = ["supplier_id", "supplier_name", "region", "reliability_rating", "contracted_since"]
    parents = suppliers.groupBy(*described).agg(F.count(F.lit(1)).alias("copies"))
    rolled = ingredients.groupBy("supplier_id").agg(
        F.countDistinct("ingredient_id").alias("ingredient_count"),
        exact_avg(F.col("unit_cost_gold")).alias("avg_unit_cost_gold"),
        F.count_if("is_hazardous").alias("hazardous"),
    )
    return parents.join(rolled, "supplier_id", "left").select(
        "supplier_id",
        "supplier_name",
        "region",
        "reliability_rating",
        F.coalesce("ingredient_count", F.lit(0)).alias("ingredient_count"),
        "avg_unit_cost_gold",
        F.coalesce(F.col("hazardous") * F.col("copies"), F.lit(0)).alias("hazardous_ingredient_count"),
        F.col("contracted_since").alias("contract_start_date"),
    )
