"""The project's data-quality checks, by table."""

from __future__ import annotations

from tallyforge.functions.conform import REGION_ALIASES
from tallyforge.operators.checks import AcceptedValues, Check, NotNull, Relationship, Unique
from tallyforge.plans.aggregates import PAYMENT_METHODS


def _key(column: str) -> tuple[Check, ...]:
    return Unique((column,)), NotNull(column)


# The accepted values of each conformed column.
ORDER_STATUSES = ("completed", "returned", "cancelled", "placed")
CHANNELS = ("in_store", "courier_owl", "marketplace")
PAYMENT_STATUSES = ("success", "failed", "refunded")
TIERS = ("apprentice", "adept", "archmage")
SEGMENTS = ("archmage", "adept", "apprentice", "prospect")
QUALITY_OUTCOMES = ("pass", "fail")

CHECKS: dict[str, tuple[Check, ...]] = {
    "stg_orders": (
        *_key("order_id"),
        NotNull("customer_id"),
        NotNull("shop_id"),
        NotNull("ordered_at"),
        AcceptedValues("order_status", ORDER_STATUSES),
        AcceptedValues("channel", CHANNELS),
    ),
    "stg_order_items": (
        *_key("order_item_id"),
        NotNull("order_id"),
        Relationship("order_id", "stg_orders", "order_id"),
        NotNull("potion_sku"),
        NotNull("quantity"),
    ),
    "stg_payments": (
        *_key("payment_id"),
        NotNull("order_id"),
        AcceptedValues("payment_method", PAYMENT_METHODS),
        AcceptedValues("payment_status", PAYMENT_STATUSES),
    ),
    "stg_potions": _key("potion_sku"),
    "stg_shops": (*_key("shop_id"), NotNull("region")),
    "stg_suppliers": _key("supplier_id"),
    "stg_ingredients": (*_key("ingredient_id"), NotNull("supplier_id")),
    "stg_potion_ingredients": (
        Unique(("potion_sku", "ingredient_id")),
        NotNull("potion_sku"),
        NotNull("ingredient_id"),
    ),
    "stg_brew_events": (
        *_key("brew_id"),
        NotNull("potion_sku"),
        AcceptedValues("quality_check", QUALITY_OUTCOMES),
    ),
    "stg_customers": (*_key("customer_id"), AcceptedValues("home_region", tuple(REGION_ALIASES))),
    "stg_guilds": _key("guild_id"),
    "stg_guild_memberships": (
        *_key("membership_id"),
        NotNull("customer_id"),
        Relationship("customer_id", "stg_customers", "customer_id"),
        NotNull("guild_id"),
        AcceptedValues("tier", TIERS),
    ),
    "fct_orders": (*_key("order_id"), NotNull("customer_id")),
    "fct_order_items": (*_key("order_item_id"), NotNull("order_id"), NotNull("potion_sku")),
    "dim_customers": (*_key("customer_id"), AcceptedValues("value_segment", SEGMENTS)),
    "dim_potions": _key("potion_sku"),
    "agg_revenue_by_region": (NotNull("shop_region"),),
}
