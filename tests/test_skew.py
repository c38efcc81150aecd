from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyforge.operators.skew import ROW_BYTES, SALT, HotKeys, _with_copies, hot_keys, spread_join, spread_left_join


@pytest.fixture(scope="module")
def many(spark):
    """A third of the rows on one key, a sixth without a key, some keys without a partner."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 6 == 1, None).otherwise(F.col("id") % 500)
    return spark.range(6000).select(F.col("id").alias("line"), key.cast("bigint").alias("k"))


@pytest.fixture(scope="module")
def one(spark):
    return spark.range(0, 400).select(F.col("id").alias("k"), (F.col("id") * 10).alias("label"))


def test_hot_keys_are_found_with_their_share(many):
    (hot,) = hot_keys(many, ["k"], 30, 1)
    assert set(hot.copies) == {7, None}
    assert hot.copies[7] == 11 and hot.copies[None] == 5


def test_no_hot_keys_without_skew(spark):
    assert not hot_keys(spark.range(10000).select(F.col("id").alias("k")), ["k"], 30, 1)[0]


def test_no_hot_keys_in_an_empty_table(spark):
    assert not hot_keys(spark.createDataFrame([], "k bigint"), ["k"], 30, 1)[0]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_equals_the_plain_join(many, one, rows, how):
    (hot,) = hot_keys(many, ["k"], 30, 1)
    spread = spread_join(many, one, "k", how, hot, F.xxhash64("line"))
    assert spread.columns == many.join(one, "k", how).columns
    assert rows(spread) == rows(many.join(one, "k", how))


def test_spread_left_join_with_the_skew_on_the_right(many, one, rows):
    (hot,) = hot_keys(many, ["k"], 30, 1)
    spread = spread_left_join(one, many, "k", hot, F.xxhash64("line"))
    assert rows(spread, "k", "label", "line") == rows(one.join(many, "k", "left"), "k", "label", "line")


def test_few_rows_on_many_tasks_lose_nothing(spark, rows):
    """Repeated left rows that meet no partner in their task must not become NULL rows."""
    many = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k bigint, v string")
    one = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k bigint")
    (hot,) = hot_keys(many, ["k"], 50, 1)
    assert hot
    got = spread_left_join(one, many, "k", hot, F.xxhash64("v"))
    assert rows(got) == rows(one.join(many, "k", "left"))


def test_a_key_listed_as_hot_may_be_absent(spark, rows):
    many = spark.createDataFrame([(2, "c")], "k bigint, v string")
    one = spark.createDataFrame([(1,), (2,)], "k bigint")
    got = spread_left_join(one, many, "k", HotKeys("k", {1: 5}), F.xxhash64("v"))
    assert rows(got) == [(1, None), (2, "c")]


def test_exact_copies_are_spread_by_position(spark, rows):
    copies = spark.range(0, 3000, 1, 8).select(F.lit(1).cast("bigint").alias("k"), F.lit("same").alias("v"))
    one = spark.createDataFrame([(1, "x")], "k bigint, label string")
    (hot,) = hot_keys(copies, ["k"], 10, 1)
    position = F.monotonically_increasing_id()
    assert spread_join(copies, one, "k", "inner", hot, position).count() == 3000
    salted = _with_copies(copies, "k", hot).groupBy(F.pmod(position, F.col("_copies")).alias(SALT)).count()
    assert salted.count() == 10 and salted.agg(F.max("count")).first()[0] < 450


def test_other_join_kinds_are_refused(many, one):
    with pytest.raises(ValueError):
        spread_join(many, one, "k", "full", None, F.lit(0))


def test_models_are_the_same_with_hot_keys_spread(spark, rows, monkeypatch):
    """Force profiling and salting of every skewable join and compare with the plain plans."""
    from tallyforge.plans import marts
    from tallyforge.settings import Settings
    from tallyforge.sources.driver_tables import DriverTables

    raw = DriverTables(spark, "/root/testdata/sf0.001")
    plain = marts.RetailMarts(raw, Settings(run_id="r"))
    forced = marts.RetailMarts(raw, Settings(run_id="r", task_bytes=1, broadcast_bytes=-1))
    measure = marts.hot_keys
    seen = []

    def eager(df, columns, total_bytes, task_bytes):
        found = measure(df, columns, 400, 1)
        seen.extend(hot.column for hot in found if hot)
        return found

    monkeypatch.setattr(marts, "hot_keys", eager)
    models = ("fct_orders", "fct_order_items", "brew_yield", "current_membership", "recipe_cost", "dim_customers",
              "category_revenue_pivot")
    for model in models:
        assert rows(getattr(forced, model)()) == rows(getattr(plain, model)()), model
    assert {"customer_id", "shop_id", "potion_sku", "ingredient_id", "guild_id"} <= set(seen)


def test_small_shares_of_large_tables_are_found(spark):
    """A key with 0.05 % of the rows fills ten of 20,000 tasks."""
    key = F.when(F.col("id") % 2000 == 0, -7).otherwise(F.col("id"))
    rows = spark.range(200_000).select(key.alias("k"))
    (hot,) = hot_keys(rows, ["k"], 20_000, 1)
    assert set(hot.copies) == {-7} and 10 <= hot.copies[-7] <= 11


def test_hot_keys_of_a_sampled_table(spark):
    """Of 1,000 tasks one key fills five, in a table of which two rows in a hundred are looked at."""
    key = F.when(F.col("id") % 200 == 3, -7).otherwise(F.col("id") % 1_000_003)
    (hot,) = hot_keys(spark.range(3_000_000).select(key.alias("k")), ["k"], 1000, 1)
    assert set(hot.copies) == {-7} and 4 <= hot.copies[-7] <= 7


def test_rows_are_counted_where_the_size_is_unknown(many):
    (hot,) = hot_keys(many, ["k"], float("inf"), 6000 * ROW_BYTES // 30)
    assert hot.copies[7] == 11
    assert not hot_keys(many, ["k"], 1000, 600)[0]
