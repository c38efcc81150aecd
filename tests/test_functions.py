from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyforge.functions import conform, measures
from tallyforge.settings import Settings


def values(spark, expression, *inputs, schema="x string"):
    df = spark.createDataFrame([(i,) if not isinstance(i, tuple) else i for i in inputs], schema)
    return [row[0] for row in df.select(expression).collect()]


def test_normalize_region(spark):
    got = values(spark, conform.normalize_region(F.col("x")), " nr ", "NR", "Marshlands", "the marshlands", "EMBER coast", "Far Isles", "", None)
    assert got == ["Northern Reaches", "Northern Reaches", "The Marshlands", "The Marshlands", "Ember Coast", None, None, None]


def test_normalize_region_takes_its_own_aliases(spark):
    assert values(spark, conform.normalize_region(F.col("x"), {"North": ("n",)}), "N ", "nr") == ["North", None]


def test_to_boolean(spark):
    got = values(spark, conform.to_boolean(F.col("x")), "T", "0", " Yes ", "FALSE", "", "maybe", None)
    assert got == [True, False, True, False, None, None, None]


def test_parse_source_timestamp(spark):
    got = values(
        spark, conform.parse_source_timestamp(F.col("x")),
        "2024-01-05T10:11:12Z", "2024-01-05 10:11:12", "2024-01-05", "2024-13-05 00:00:00", "n/a", "", None,
    )
    at = datetime(2024, 1, 5, 10, 11, 12)
    assert got == [at, at, datetime(2024, 1, 5), None, None, None, None]


def test_parsing_does_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        at = conform.parse_source_timestamp(F.col("x"))
        got = values(spark, F.struct(at, measures.period_start(at, "month")), "2024-03-10T02:30:00Z")
        assert tuple(got[0]) == (datetime(2024, 3, 10, 2, 30), datetime(2024, 3, 1))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_parse_source_date(spark):
    got = values(spark, conform.parse_source_date(F.col("x")), "2024-02-29", "2024-13-05", "2024", "", None)
    assert got == [date(2024, 2, 29), None, None, None, None]


def test_blank_to_null(spark):
    assert values(spark, conform.blank_to_null(F.col("x")), " a@b ", "", "   ", None) == ["a@b", None, None, None]


def test_coalesce_region(spark):
    df = spark.createDataFrame([("S", "C"), (None, "C"), (None, None)], "s string, c string")
    got = df.select(conform.coalesce_region(F.col("s"), F.col("c"))).collect()
    assert [row[0] for row in got] == ["S", "C", "unknown"]


def test_copper_to_gold_takes_its_argument_as_a_unit(spark):
    df = spark.createDataFrame([(12345, 678)], "gross bigint, discount bigint")
    net = measures.copper_to_gold(F.col("gross") - F.col("discount"))
    assert df.select(net).first()[0] == Decimal("116.67")


@pytest.mark.parametrize(("copper", "rate", "gold"), [(5, 1000, "0.01"), (4, 1000, "0.00"), (-5, 1000, "-0.01"), (10, 3, "3.33"), (None, 100, None)])
def test_copper_to_gold_rounds_half_up(spark, copper, rate, gold):
    got = values(spark, measures.copper_to_gold(F.col("x"), rate), copper, schema="x bigint")
    assert got == [gold and Decimal(gold)]


def test_safe_divide(spark):
    data = [(6, 3), (6, 0), (None, 3), (6, None)]
    plain = measures.safe_divide(F.col("n"), F.col("d"))
    with_default = measures.safe_divide(F.col("n"), F.col("d"), F.lit(-1.0))
    assert values(spark, plain, *data, schema="n int, d int") == [2.0, None, None, None]
    assert values(spark, with_default, *data, schema="n int, d int") == [2.0, -1.0, -1.0, -1.0]


def test_pct_change(spark):
    got = values(spark, measures.pct_change(F.col("c"), F.col("p")), (150, 100), (100, 300), (5, 0), (5, None), schema="c int, p int")
    assert got == [0.5, -0.6667, None, None]


def test_bucket_amount(spark):
    got = values(spark, measures.bucket_amount(F.col("x"), 10, 20), 20, 19, 10, 9, 0, -1, None, schema="x int")
    assert got == ["high", "medium", "medium", "low", "none", "none", "none"]


def test_days_between_counts_midnights(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 23:00:00' a, timestamp_ntz'2024-01-02 01:00:00' b")
    assert tuple(df.select(measures.days_between(F.col("a"), F.col("b")), measures.days_between(F.col("b"), F.col("a"))).first()) == (1, -1)


def test_is_weekend(spark):
    days = [(datetime(2024, 1, day),) for day in range(5, 9)] + [(None,)]
    got = values(spark, measures.is_weekend(F.col("x")), *days, schema="x timestamp_ntz")
    assert got == [False, True, True, False, None]


def test_period_start(spark):
    at = datetime(2024, 5, 31, 23, 59, 59)
    got = values(spark, F.struct(*(measures.period_start(F.col("x"), u) for u in ("month", "quarter"))), at, schema="x timestamp_ntz")
    assert tuple(got[0]) == (datetime(2024, 5, 1), datetime(2024, 4, 1))


def test_settings_reject_nonsense():
    with pytest.raises(ValueError):
        Settings(copper_per_gold=0)
    with pytest.raises(ValueError):
        Settings(run_mode="nightly")
    with pytest.raises(TypeError):
        Settings(copper_per_crown=1)


@pytest.mark.parametrize("unit", ["day", "week", "months", ""])
def test_other_periods_are_refused(unit):
    with pytest.raises(ValueError, match="no period"):
        measures.period_start(F.lit("2024-01-05"), unit)
