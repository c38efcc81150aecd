"""Staging models: one raw extract in, typed and conformed columns out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType

from tallyforge.functions.conform import (
    blank_to_null,
    clean_token,
    normalize_region,
    parse_source_date,
    parse_source_timestamp,
    to_boolean,
)
from tallyforge.functions.measures import copper_to_gold
from tallyforge.settings import Settings


def _conformed(raw: DataFrame, name: str, target: type, parse: Callable[[Column], Column]) -> Column:
    """Parse a text column; one that already landed with the target type passes untouched."""
    landed = raw.schema[name].dataType
    if isinstance(landed, target):
        return F.col(name)
    if not isinstance(landed, StringType):
        raise TypeError(f"{name} landed as {landed.simpleString()}")
    return parse(F.col(name))


def _timestamp(raw: DataFrame, name: str) -> Column:
    return _conformed(raw, name, TimestampNTZType, parse_source_timestamp).alias(name)


def _date(raw: DataFrame, name: str) -> Column:
    return _conformed(raw, name, DateType, parse_source_date).alias(name)


def _token(name: str, alias: str | None = None) -> Column:
    return clean_token(F.col(name)).alias(alias or name)


def orders(raw: DataFrame, settings: Settings) -> DataFrame:
    return raw.select(
        "order_id",
        "customer_id",
        "shop_id",
        _timestamp(raw, "ordered_at"),
        _token("status", "order_status"),
        _token("channel"),
        "discount_copper",
        copper_to_gold(F.col("discount_copper"), settings.copper_per_gold).alias("discount_gold"),
    )


LINE_COLUMNS = ("order_item_id", "order_id", "potion_sku", "quantity", "unit_price_copper")


def line_amounts(settings: Settings) -> list[Column]:
    """The amounts a line's quantity and price determine."""
    price = F.col("unit_price_copper")
    gross = F.col("quantity") * price
    return [
        copper_to_gold(price, settings.copper_per_gold).alias("unit_price_gold"),
        gross.alias("gross_line_amount_copper"),
        copper_to_gold(gross, settings.copper_per_gold).alias("gross_line_amount_gold"),
    ]


def order_items(raw: DataFrame, settings: Settings) -> DataFrame:
    return raw.select(*LINE_COLUMNS, *line_amounts(settings))


def payments(raw: DataFrame, settings: Settings) -> DataFrame:
    return raw.select(
        "payment_id",
        "order_id",
        _token("method", "payment_method"),
        _token("status", "payment_status"),
        "amount_copper",
        copper_to_gold(F.col("amount_copper"), settings.copper_per_gold).alias("amount_gold"),
        _timestamp(raw, "paid_at"),
    )


def potions(raw: DataFrame, settings: Settings) -> DataFrame:
    return raw.select(
        "potion_sku",
        "potion_name",
        _token("category"),
        "base_price_copper",
        copper_to_gold(F.col("base_price_copper"), settings.copper_per_gold).alias("base_price_gold"),
        "potency",
        "shelf_life_days",
        to_boolean(F.col("is_regulated")).alias("is_regulated"),
        _date(raw, "introduced_at"),
    )


def shops(raw: DataFrame) -> DataFrame:
    return raw.select("shop_id", "shop_name", "city", "region", _date(raw, "opened_at"))


def suppliers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "supplier_id", "supplier_name", "region", "reliability_rating", _date(raw, "contracted_since")
    )


def ingredients(raw: DataFrame, settings: Settings) -> DataFrame:
    return raw.select(
        "ingredient_id",
        "ingredient_name",
        "supplier_id",
        _token("unit"),
        "unit_cost_copper",
        copper_to_gold(F.col("unit_cost_copper"), settings.copper_per_gold).alias("unit_cost_gold"),
        to_boolean(F.col("is_hazardous")).alias("is_hazardous"),
        _token("harvest_season"),
    )


def potion_ingredients(raw: DataFrame) -> DataFrame:
    return raw.select("potion_sku", "ingredient_id", "quantity", _token("unit"))


def brew_events(raw: DataFrame) -> DataFrame:
    return raw.select(
        "brew_id",
        "potion_sku",
        "shop_id",
        "cauldron_id",
        _timestamp(raw, "brewed_at"),
        "batch_size",
        "brew_duration_minutes",
        _token("quality_check"),
        "brewer_name",
    )


def customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "customer_id",
        "full_name",
        blank_to_null(F.col("email")).alias("email"),
        normalize_region(F.col("home_region")).alias("home_region"),
        _date(raw, "signed_up_at"),
        "birth_year",
        _token("favored_discipline"),
    )


def guilds(raw: DataFrame) -> DataFrame:
    return raw.select("guild_id", "guild_name", "founded_year")


def guild_memberships(raw: DataFrame) -> DataFrame:
    closed_on = blank_to_null(F.col("valid_to"))
    return raw.select(
        "membership_id",
        "customer_id",
        "guild_id",
        _token("tier"),
        _date(raw, "valid_from"),
        parse_source_date(closed_on).alias("valid_to"),
        closed_on.isNull().alias("is_current_membership"),
    )
