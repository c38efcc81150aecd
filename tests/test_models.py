from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyforge.operators.pivots import discover_values, pivot_present_values, sums_by_value
from tallyforge.plans import aggregates, dimensions, facts, staging
from tallyforge.plans.marts import RetailMarts
from tallyforge.settings import Settings
from tallyforge.sources.extracts import SCHEMAS, CatalogTables, ExtractFolder

SETTINGS = Settings(run_id="test")
RAW = {
    "raw_orders": [
        ("O1", "C1", "S1", "2024-01-06T10:00:00Z", " Completed", "IN_STORE", 678),
        ("O2", "C1", "S1", "2024-01-08 23:30:00", "completed ", "courier_owl", None),
        ("O3", "C2", "S9", "bad", "RETURNED", "Marketplace", 0),
        ("O4", "C9", "S2", "2024-02-01T00:00:00Z", "Placed", "in_store", 0),
        ("O5", None, None, "2024-02-03 08:00:00", "completed", "in_store", 0),
    ],
    "raw_order_items": [
        ("I1", "O1", "P1", 3, 4115),
        ("I2", "O2", "P2", 1, 1000),
        ("I3", "O2", "P9", 2, 5),
        ("I4", "O4", "P1", 1, 4115),
        ("I5", "O7", "P1", 1, 1),
    ],
    "raw_payments": [
        ("Y1", "O1", "Guild_Credit", "SUCCESS", 5000, "2024-01-06T10:01:00Z"),
        ("Y2", "O1", " coin", "success", 6667, "2024-01-06 10:02:00"),
        ("Y3", "O2", "barter", "Failed", 1010, "2024-01-09T00:00:00Z"),
        ("Y4", "O3", "coin", "refunded", 300, None),
        ("Y5", "O3", "barter", None, 50, None),
    ],
    "raw_potions": [
        ("P1", "Pulse", " Healing", 4000, 5, 30, "Y", "2021-11-02"),
        ("P2", "Fog", "night vision", 0, 3, 60, "no", "2024-13-05"),
        ("P3", "Air", None, 100, 1, 90, None, None),
    ],
    "raw_shops": [("S1", "Gilded", "Alder", "Ember Coast", "2014-07-01"), ("S2", "Moon", "Frost", "Silverwood", "x")],
    "raw_suppliers": [("U1", "Ember", "Ember Coast", 3, "2018-02-12"), ("U2", "Alone", "Silverwood", 1, None)],
    "raw_ingredients": [
        ("G1", "petal", "U1", "Gram ", 79, "N", "Summer"),
        ("G2", "scale", "U1", "vial", 141, "yes", " SPRING"),
        ("G3", "root", "U1", "VIAL", 10, None, None),
    ],
    "raw_potion_ingredients": [("P1", "G1", 2, "GRAM"), ("P1", "G3", 1, "vial"), ("P2", "G2", 1, "vial"), ("P3", "G9", 1, "x")],
    "raw_brew_events": [
        ("B1", "P1", "S1", "K1", "2024-01-01T23:50:00Z", 20, 40, "PASS", "Ann"),
        ("B2", "P1", "S1", "K1", "2024-01-02 08:00:00", 10, None, " fail", "Ann"),
        ("B3", "P1", "S1", "K2", "2024-01-02 09:00:00", 10, 0, None, "Bo"),
        ("B4", "P9", "S1", "K2", "2024-01-02 09:00:00", 10, 5, "pass", "Bo"),
    ],
    "raw_customers": [
        ("C1", "Ann", " a@b ", "nr", "2020-01-01", 1950, " Fire"),
        ("C2", "Bo", "  ", "Nowhere", "2020-13-01", None, "ICE"),
        ("C3", "Cy", None, "The Marshlands", None, 1970, None),
    ],
    "raw_guilds": [("L1", "Quill", 1778), ("L2", "Flask", 1905)],
    "raw_guild_memberships": [
        ("M1", "C1", "L1", "Adept", "2020-01-01", "2021-01-01"),
        ("M2", "C1", "L2", "ARCHMAGE ", "2021-01-01", ""),
        ("M3", "C2", "L1", "adept", "2021-01-01", "  "),
        ("M4", "C2", "L2", "adept", "2021-05-01", None),
    ],
}


class Crafted:
    def __init__(self, spark):
        self.spark = spark

    def table(self, name):
        return self.spark.createDataFrame(RAW[name], SCHEMAS[name])

    def source_paths(self, name):
        return []


@pytest.fixture(scope="module")
def marts(spark):
    return RetailMarts(Crafted(spark), SETTINGS)


def by(df, key):
    return {row[key]: row for row in df.collect()}


def test_order_fact(marts):
    orders = by(marts.fct_orders(), "order_id")
    assert len(orders) == 5
    first = orders["O1"]
    assert (first.order_status, first.channel, first.is_weekend_order) == ("completed", "in_store", True)
    assert (first.gross_amount_copper, first.net_amount_copper) == (12345, 11667)
    assert first.net_amount_gold == Decimal("116.67")
    assert (first.collected_copper, first.collected_gold, first.payment_attempt_count) == (11667, Decimal("116.67"), 2)
    assert first.primary_payment_method == "coin"
    assert first.last_payment_at == datetime(2024, 1, 6, 10, 2)


def test_order_with_only_failed_payments(marts):
    order = by(marts.fct_orders(), "order_id")["O2"]
    assert (order.collected_gold, order.failed_payment_count, order.primary_payment_method) == (0, 1, None)
    assert order.discount_copper is None and order.net_amount_gold is None


def test_order_without_lines_shop_or_time(marts):
    order = by(marts.fct_orders(), "order_id")["O3"]
    assert order.line_count is None and order.gross_amount_gold is None and order.shop_region is None
    assert order.ordered_at is None and order.is_weekend_order is None
    assert (order.refunded_gold, order.payment_attempt_count, order.last_payment_at) == (Decimal("3.00"), 2, None)


def test_order_without_payments_counts_zero(marts):
    order = by(marts.fct_orders(), "order_id")["O4"]
    assert (order.collected_copper, order.refunded_gold, order.payment_attempt_count) == (0, 0, 0)
    assert order.customer_name is None


def test_audit_columns(marts):
    stamped = marts.fct_orders_audited()
    assert stamped.columns[-2:] == ["loaded_at", "run_id"]
    assert {row.run_id for row in stamped.collect()} == {"test"}


def test_line_fact_drops_lines_without_an_order_and_keeps_unknown_potions(marts):
    lines = by(marts.fct_order_items(), "order_item_id")
    assert set(lines) == {"I1", "I2", "I3", "I4"}
    assert lines["I3"].potion_category is None and lines["I2"].potion_category == "night vision"


def test_regulated_sales(marts):
    sold = marts.regulated_sales().collect()
    assert [(row.order_item_id, row.reporting_quarter) for row in sold] == [("I1", datetime(2024, 1, 1))]


def test_brew_yield(marts):
    brews = by(marts.brew_yield(), "brew_id")
    assert set(brews) == {"B1", "B2", "B3"}
    assert (brews["B1"].units_per_minute, brews["B1"].brew_finished_at) == (0.5, datetime(2024, 1, 2, 0, 30))
    assert brews["B2"].units_per_minute is None and brews["B2"].brew_finished_at is None
    assert brews["B3"].units_per_minute is None and brews["B3"].brew_finished_at == brews["B3"].brewed_at


def test_customers(marts):
    customers = marts.dim_customers().collect()
    first = [c for c in customers if c.customer_id == "C1"]
    assert [(c.guild_tier, c.guild_name, c.email) for c in first] == [("archmage", "Flask", "a@b")]
    assert (first[0].lifetime_order_count, first[0].lifetime_collected_gold) == (2, Decimal("116.67"))
    assert first[0].value_segment == "apprentice" and first[0].home_region == "Northern Reaches"
    assert first[0].most_recent_order_at == datetime(2024, 1, 8, 23, 30)
    assert [c.guild_tier_since for c in customers if c.customer_id == "C2"].sort() is None
    assert len([c for c in customers if c.customer_id == "C2"]) == 2  # two open memberships
    assert [(c.email, c.lifetime_order_count, c.value_segment) for c in customers if c.customer_id == "C3"] == [(None, 0, "prospect")]


@pytest.mark.parametrize(("gold", "segment"), [("0", "prospect"), ("0.01", "apprentice"), ("149.99", "apprentice"), ("150", "adept"), ("499.99", "adept"), ("500", "archmage")])
def test_segment_bounds(spark, gold, segment):
    customers = staging.customers(Crafted(spark).table("raw_customers")).filter("customer_id = 'C1'")
    activity = spark.createDataFrame(
        [("C1", 1, Decimal(gold), None, None)],
        """customer_id string, lifetime_order_count bigint, lifetime_collected_gold decimal(28,2),
        first_order_at timestamp_ntz, most_recent_order_at timestamp_ntz""",
    )
    nobody = spark.createDataFrame([], "membership_id string, customer_id string, guild_id string, guild_name string, tier string, tier_since date")
    assert dimensions.dim_customers(customers, nobody, activity).first().value_segment == segment


def test_potions(marts):
    potions = by(marts.dim_potions(), "potion_sku")
    first, free, bare = potions["P1"], potions["P2"], potions["P3"]
    assert (first.ingredient_count, first.recipe_cost_copper, first.has_hazardous_ingredient) == (2, 168, False)
    assert (first.unit_margin_copper, first.unit_margin_pct, first.recipe_cost_gold) == (3832, 0.958, Decimal("1.68"))
    assert (first.brew_event_count, first.total_units_brewed, first.avg_brew_duration_minutes) == (3, 40, 20.0)
    assert first.brew_failure_rate == pytest.approx(1 / 3)
    assert (free.unit_margin_copper, free.unit_margin_pct, free.has_hazardous_ingredient) == (-141, None, True)
    assert free.introduced_at is None and free.brew_event_count is None
    assert bare.ingredient_count is None and bare.unit_margin_pct is None


def test_supplier_scorecard(marts):
    suppliers = by(marts.supplier_scorecard(), "supplier_id")
    assert suppliers["U1"][4:7] == (3, pytest.approx(2.30 / 3), 1)
    assert suppliers["U2"][4:] == (0, None, 0, None)
    assert suppliers["U1"].contract_start_date == date(2018, 2, 12)


def test_copies_of_a_supplier_count_as_grouping_after_the_join_would(spark, rows):
    suppliers = staging.suppliers(Crafted(spark).table("raw_suppliers"))
    ingredients = staging.ingredients(Crafted(spark).table("raw_ingredients"), SETTINGS)
    doubled = suppliers.unionAll(suppliers)
    described = ["supplier_id", "supplier_name", "region", "reliability_rating", "contracted_since"]
    expected = doubled.join(ingredients, "supplier_id", "left").groupBy(*described).agg(
        F.countDistinct("ingredient_id").alias("n"), F.count_if("is_hazardous").alias("h")
    )
    got = dimensions.supplier_scorecard(doubled, ingredients)
    assert rows(got, "supplier_id", "ingredient_count", "hazardous_ingredient_count") == rows(expected, "supplier_id", "n", "h")


def test_revenue_by_region(marts, rows):
    got = rows(marts.revenue_by_region(), "shop_region", "order_month", "shop_count", "order_count",
               "gross_revenue_gold", "returned_order_count", "gross_revenue_gold_per_shop")
    jan, feb = datetime(2024, 1, 1), datetime(2024, 2, 1)
    assert got == sorted([
        ("Ember Coast", jan, 1, 2, Decimal("133.55"), 0, Decimal("133.55")),
        ("Silverwood", feb, 1, 1, Decimal("41.15"), 0, Decimal("41.15")),
        (None, None, None, 1, None, 1, None),
        (None, feb, None, 1, None, 0, None),
    ], key=repr)


def test_channel_mix_stacks_the_labelled_rows(marts, rows):
    labelled = marts.channel_mix_labelled()
    assert {row[0] for row in rows(labelled, "channel")} == {"in_store", "courier_owl"}
    assert rows(marts.channel_mix()) == rows(labelled.drop("channel"))


def test_category_pivot_columns_and_total(marts):
    pivot = marts.category_revenue_pivot()
    assert pivot.columns == ["shop_region", "order_month", "revenue_healing_gold", "revenue_night_vision_gold",
                             "revenue_total_gold", "order_count"]
    row = pivot.filter("shop_region = 'Ember Coast'").first()
    # The line of an unknown potion has no category: it is in the total only.
    assert tuple(row)[2:] == (Decimal("123.45"), Decimal("10.00"), Decimal("133.55"), 2)


def test_pivot_columns_add_up_to_the_total(spark):
    from tallyforge.sources.driver_tables import DriverTables

    pivot = RetailMarts(DriverTables(spark, "/root/testdata/sf0.001")).category_revenue_pivot()
    parts = sum(F.col(c) for c in pivot.columns[2:-2])
    assert pivot.filter(parts != F.col("revenue_total_gold")).isEmpty()


def test_discovered_values_fall_back_when_there_are_none(spark):
    empty = spark.createDataFrame([], "category string")
    assert discover_values(empty, "category", ["x"]) == ["x"]
    assert discover_values(None, "category", ["x"]) == ["x"]
    nulls = spark.createDataFrame([(None,)], "category string")
    assert discover_values(nulls, "category", ["x"]) == ["x"]
    many = spark.range(1100).select(F.format_string("v%04d", "id").alias("c"))
    assert discover_values(many, "c", []) == [f"v{k:04d}" for k in range(1100)]
    sums = spark.range(1100).select(F.lit(1).alias("g"), F.format_string("v%04d", "id").alias("c"), F.col("id").alias("x"))
    assert len(pivot_present_values(sums, "g", "c", "x").columns) == 1101


def test_colliding_pivot_columns_are_refused():
    with pytest.raises(ValueError, match="share a column"):
        sums_by_value(["a b", "a_b"], F.col("c"), F.col("x"), "{}")


def test_declared_pivot_drops_unlisted_values_and_the_dynamic_one_keeps_them(spark, rows):
    data = [("R", "completed", "coin", Decimal("1.00")), ("R", "completed", "moss", Decimal("2.00")),
            ("R", "completed", None, Decimal("4.00")), ("R", "returned", "coin", Decimal("8.00"))]
    orders = spark.createDataFrame(
        data, "shop_region string, order_status string, primary_payment_method string, collected_gold decimal(18,2)")
    declared = aggregates.payment_method_mix(orders).first().asDict()
    assert declared == {"shop_region": "R", "coin": 1, "guild_credit": None, "crystal_transfer": None, "barter": None}
    assert aggregates.payment_method_mix_dynamic(orders).first().asDict() == {"shop_region": "R", "coin": 1, "moss": 2}
    total = aggregates.payment_mix_total(orders).first().asDict()
    assert (total["collected_gold_coin"], total["collected_gold_barter"], total["collected_gold_total"]) == (9, 0, 15)


def test_pivot_of_nothing(spark):
    empty = spark.createDataFrame([], "g string, c string, x decimal(18,2)")
    assert pivot_present_values(empty, "g", "c", "x").columns == ["g"]


def test_rounding_order_differs_at_other_rates(spark):
    """Lines round one by one, orders round their copper sum."""
    items = spark.createDataFrame([("I1", "O", "P", 1, 10), ("I2", "O", "P", 1, 10)], SCHEMAS["raw_order_items"])
    thirds = Settings(copper_per_gold=3)
    lines = staging.order_items(items, thirds)
    assert lines.agg(F.sum("gross_line_amount_gold")).first()[0] == Decimal("6.66")
    assert facts.order_item_totals(lines, thirds).first().gross_amount_gold == Decimal("6.67")


def test_typed_columns_pass_through_staging(spark):
    landed = spark.sql("SELECT 1 payment_id, 1 order_id, 'coin' method, 'success' status, 5L amount_copper, timestamp_ntz'2024-01-01 00:00:00' paid_at")
    assert staging.payments(landed, SETTINGS).first().paid_at == datetime(2024, 1, 1)
    with pytest.raises(TypeError, match="landed as"):
        staging.payments(landed.withColumn("paid_at", F.lit(5)), SETTINGS)


def test_models_over_csv_extracts(spark, tmp_path, marts, rows):
    for name in RAW:
        Crafted(spark).table(name).write.option("header", True).csv(str(tmp_path / f"{name}.csv"))
    landed = RetailMarts(ExtractFolder(spark, str(tmp_path)), SETTINGS)
    for model in ("fct_orders", "dim_customers", "dim_potions", "supplier_scorecard", "brew_yield"):
        assert rows(getattr(landed, model)()) == rows(getattr(marts, model)())


def test_models_over_session_views(spark, marts, rows):
    for name in RAW:
        Crafted(spark).table(name).createOrReplaceTempView(name)
    over_views = RetailMarts(CatalogTables(spark), SETTINGS)
    assert rows(over_views.fct_orders()) == rows(marts.fct_orders())


def test_lookups_of_unknown_size_are_not_broadcast(spark, marts, capsys):
    assert marts._bytes("raw_shops") == float("inf")
    marts._lookup("raw_shops", marts.stg_shops()).explain("extended")
    assert "ResolvedHint" not in capsys.readouterr().out


def test_catalog_table_location(spark, tmp_path):
    path = str(tmp_path / "guilds")
    Crafted(spark).table("raw_guilds").write.parquet(path)
    spark.sql(f"CREATE TABLE catalog_guilds USING parquet LOCATION '{path}'")
    try:
        assert CatalogTables(spark, "default").source_paths("catalog_guilds") == [f"file:{path}"]
    finally:
        spark.sql("DROP TABLE catalog_guilds")
