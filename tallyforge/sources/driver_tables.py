"""The retail extracts expressed over a TPC-H-like star schema plus an event stream.

Each method yields one raw table, deliberately messy: two timestamp shapes, mixed case and
padding, four region codings, assorted boolean tokens, blanks and bad dates. Keys stay
BIGINT. Payments keep their landed timestamp type, so window filters reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyforge.sources.extracts import read_parquet

SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": """p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT,
        p_retailprice DOUBLE""",
    "orders": """o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,
        o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING""",
    "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,
        l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE,
        l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ""",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}

# Canonical region names and two-letter codes, by region key, and the listed methods and tiers.
REGIONS = "array('Northern Reaches', 'Crystal Vale', 'The Marshlands', 'Ember Coast', 'Silverwood')"
REGION_CODES = "array('NR', 'CV', 'ML', 'EC', 'SW')"
PAYMENT_METHODS = "array('coin', 'guild_credit', 'crystal_transfer', 'barter')"
TIERS = "array('apprentice', 'adept', 'archmage')"
UNITS = "array('gram', 'vial', 'dram', 'pinch')"
SEASONS = "array('spring', 'summer', 'autumn')"
BOOLEAN_TOKENS = "array('Y', 'n', ' TRUE', 'No', '1', '0', 't', 'F ', 'yes', 'maybe')"


def _pick(values: str, index: str) -> str:
    return f"element_at({values}, int({index}) + 1)"


def _copper(amount: str) -> str:
    return f"bigint(round({amount} * 100))"


def _mixed_case(text: str, key: str) -> str:
    return f"CASE {key} % 3 WHEN 0 THEN upper({text}) WHEN 1 THEN concat(' ', {text}, ' ') ELSE {text} END"


def _two_shapes(at: str, key: str) -> str:
    return f"if({key} % 2 = 0, concat(replace(string({at}), ' ', 'T'), 'Z'), string({at}))"


def _day_text(first: str, offset: str) -> str:
    return f"string(date_add(DATE '{first}', int({offset})))"


class DriverTables:
    """Raw retail tables over the Parquet star schema in ``root``."""

    INPUTS = {
        "raw_orders": ("orders",),
        "raw_order_items": ("lineitem",),
        "raw_payments": ("events",),
        "raw_potions": ("part",),
        "raw_shops": ("nation", "region"),
        "raw_suppliers": ("nation",),
        "raw_ingredients": ("supplier",),
        "raw_potion_ingredients": ("lineitem",),
        "raw_brew_events": ("events",),
        "raw_customers": ("customer", "nation"),
        "raw_guilds": ("nation",),
        "raw_guild_memberships": ("customer",),
    }

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def parquet(self, name: str) -> DataFrame:
        return read_parquet(self.spark, f"{self.root}/{name}.parquet", SCHEMAS[name])

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)()

    def source_paths(self, name: str) -> list[str]:
        return [f"{self.root}/{source}.parquet" for source in self.INPUTS[name]]

    def raw_orders(self) -> DataFrame:
        """Shop 25 is on no shop list; some orders have no readable time or no discount."""
        status = """(CASE WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderstatus = 'P' THEN 'returned'
            WHEN o_orderkey % 4 = 0 THEN 'cancelled' ELSE 'placed' END)"""
        channel = """(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'courier_owl'
            WHEN o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN 'in_store' ELSE 'marketplace' END)"""
        at = "timestampadd(MINUTE, int(o_orderkey % 1440), o_orderdate)"
        return self.parquet("orders").selectExpr(
            "o_orderkey AS order_id",
            "o_custkey AS customer_id",
            "int(o_custkey % 26) AS shop_id",
            f"if(o_orderkey % 251 = 0, 'n/a', {_two_shapes(at, 'o_orderkey')}) AS ordered_at",
            f"{_mixed_case(status, 'o_orderkey')} AS status",
            f"{_mixed_case(channel, 'o_orderkey')} AS channel",
            f"if(o_orderkey % 37 = 0, NULL, {_copper('o_totalprice')} % 1000) AS discount_copper",
        )

    def raw_order_items(self) -> DataFrame:
        return self.parquet("lineitem").selectExpr(
            "concat_ws('-', l_orderkey, l_linenumber) AS order_item_id",
            "l_orderkey AS order_id",
            "l_partkey AS potion_sku",
            "int(l_quantity) AS quantity",
            f"{_copper('l_extendedprice')} AS unit_price_copper",
        )

    def raw_payments(self) -> DataFrame:
        """A quarter of the attempts fall on few orders; the rest come about three to an order."""
        status = "(CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'refunded' ELSE 'success' END)"
        method = _pick(PAYMENT_METHODS, "event_id div 4 % 4")
        return self.parquet("events").selectExpr(
            "event_id AS payment_id",
            "if(event_id % 4 = 0, user_id, event_id - event_id % 3) AS order_id",
            f"{_mixed_case(method, 'event_id')} AS method",
            f"{_mixed_case(status, 'event_id')} AS status",
            f"{_copper('value')} AS amount_copper",
            "ts AS paid_at",
        )

    def raw_potions(self) -> DataFrame:
        introduced = f"""CASE WHEN p_partkey % 89 = 0 THEN '2024-13-05' WHEN p_partkey % 97 = 0 THEN '2024'
            ELSE {_day_text("2018-01-01", "p_partkey % 2500")} END"""
        return self.parquet("part").selectExpr(
            "p_partkey AS potion_sku",
            "p_name AS potion_name",
            f"{_mixed_case('lower(p_type)', 'p_partkey')} AS category",
            f"if(p_partkey % 101 = 0, 0, {_copper('p_retailprice')}) AS base_price_copper",
            "p_size AS potency",
            "int(30 + p_partkey % 12 * 30) AS shelf_life_days",
            f"{_pick(BOOLEAN_TOKENS, 'p_size % 10')} AS is_regulated",
            f"{introduced} AS introduced_at",
        )

    def raw_shops(self) -> DataFrame:
        nation, region = self.parquet("nation"), self.parquet("region")
        return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).selectExpr(
            "n_nationkey AS shop_id",
            "concat('Shop ', n_name) AS shop_name",
            "r_name AS city",
            f"{_pick(REGIONS, 'r_regionkey')} AS region",
            f"{_day_text('2010-01-01', 'n_nationkey * 97')} AS opened_at",
        )

    def raw_suppliers(self) -> DataFrame:
        since = f"if(n_nationkey % 11 = 5, 'unknown', {_day_text('2012-03-01', 'n_nationkey * 61')})"
        return self.parquet("nation").selectExpr(
            "n_nationkey AS supplier_id",
            "concat('Supplier ', n_name) AS supplier_name",
            f"{_pick(REGIONS, 'n_regionkey')} AS region",
            "1 + n_nationkey % 5 AS reliability_rating",
            f"{since} AS contracted_since",
        )

    def raw_ingredients(self) -> DataFrame:
        return self.parquet("supplier").selectExpr(
            "s_suppkey AS ingredient_id",
            "s_name AS ingredient_name",
            "s_nationkey AS supplier_id",
            f"{_mixed_case(_pick(UNITS, 's_suppkey % 4'), 's_suppkey')} AS unit",
            f"{_copper('abs(s_acctbal)')} AS unit_cost_copper",
            f"{_pick(BOOLEAN_TOKENS, 's_suppkey % 10')} AS is_hazardous",
            f"{_mixed_case(_pick(SEASONS, 's_suppkey % 3'), 's_suppkey')} AS harvest_season",
        )

    def raw_potion_ingredients(self) -> DataFrame:
        pairs = self.parquet("lineitem").selectExpr("l_partkey", "l_suppkey", "int(l_quantity) AS quantity")
        return pairs.groupBy("l_partkey", "l_suppkey").sum("quantity").selectExpr(
            "l_partkey AS potion_sku",
            "l_suppkey AS ingredient_id",
            "`sum(quantity)` AS quantity",
            f"{_mixed_case(_pick(UNITS, 'l_suppkey % 4'), 'l_suppkey')} AS unit",
        )

    def raw_brew_events(self) -> DataFrame:
        minutes = "CASE event_id % 100 WHEN 0 THEN NULL WHEN 50 THEN 0 ELSE event_id % 100 END"
        quality = """(CASE WHEN event_type = 'error' THEN 'fail'
            WHEN event_type <> 'view' OR event_id % 10 <> 0 THEN 'pass' END)"""
        return self.parquet("events").selectExpr(
            "event_id AS brew_id",
            "user_id AS potion_sku",
            "int(event_id % 25) AS shop_id",
            "concat('CLD-', event_id % 7) AS cauldron_id",
            f"{_two_shapes('ts', 'event_id')} AS brewed_at",
            "int(1 + event_id % 20) AS batch_size",
            f"int({minutes}) AS brew_duration_minutes",
            f"{_mixed_case(quality, 'event_id')} AS quality_check",
            "concat('Brewer ', event_id % 13) AS brewer_name",
        )

    def raw_customers(self) -> DataFrame:
        name, code = _pick(REGIONS, "n_regionkey"), _pick(REGION_CODES, "n_regionkey")
        home = f"""CASE WHEN c_custkey % 97 = 0 THEN 'Far Isles' WHEN c_custkey % 4 = 0 THEN {code}
            WHEN c_custkey % 4 = 1 THEN lower({code}) WHEN c_custkey % 4 = 2 THEN concat(' ', {name})
            ELSE lower({name}) END"""
        signed_up = f"if(c_custkey % 113 = 0, '2024-13-05', {_day_text('2015-01-01', 'c_custkey % 2000')})"
        customer, nation = self.parquet("customer"), self.parquet("nation")
        return customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"], "left").selectExpr(
            "c_custkey AS customer_id",
            "c_name AS full_name",
            "if(c_custkey % 50 = 0, '  ', concat('c', c_custkey, '@example.org ')) AS email",
            f"{home} AS home_region",
            f"{signed_up} AS signed_up_at",
            "int(1940 + c_custkey % 60) AS birth_year",
            f"{_mixed_case('lower(c_mktsegment)', 'c_custkey')} AS favored_discipline",
        )

    def raw_guilds(self) -> DataFrame:
        return self.parquet("nation").selectExpr(
            "n_nationkey AS guild_id", "concat('Guild ', n_name) AS guild_name", "1700 + n_nationkey * 7 AS founded_year"
        )

    def raw_guild_memberships(self) -> DataFrame:
        """One interval per customer; four in five are open."""
        return self.parquet("customer").selectExpr(
            "c_custkey AS membership_id",
            "c_custkey AS customer_id",
            "int(c_custkey % 25) AS guild_id",
            f"{_mixed_case(_pick(TIERS, 'c_custkey % 3'), 'c_custkey')} AS tier",
            f"{_day_text('2019-01-01', 'c_custkey % 1000')} AS valid_from",
            f"if(c_custkey % 5 = 0, {_day_text('2022-01-01', 'c_custkey % 700')}, ' ') AS valid_to",
        )

    def raw_guild_memberships_later(self) -> DataFrame:
        """The next day's extract: promotions, closures, departures and new members."""
        first = self.raw_guild_memberships()
        kept = first.filter("membership_id % 17 <> 0").selectExpr(
            "membership_id",
            "customer_id",
            "guild_id",
            "if(membership_id % 10 = 0, 'Archmage', tier) AS tier",
            "valid_from",
            "if(membership_id % 10 = 3, '2024-01-31', valid_to) AS valid_to",
        )
        joined = first.filter("membership_id % 20 = 0").selectExpr(
            "-membership_id - 1 AS membership_id",
            "customer_id",
            "guild_id",
            "'apprentice' AS tier",
            "'2024-02-01' AS valid_from",
            "'' AS valid_to",
        )
        return kept.unionByName(joined)
