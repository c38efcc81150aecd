"""Column functions for money, ratios, bands and calendar arithmetic.

Arguments are ``Column`` objects, so a compound argument such as ``gross - discount`` is
always evaluated as a unit before it is divided or rounded.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

GOLD = "decimal(18,2)"


def copper_to_gold(copper: Column, rate: int = 100) -> Column:
    """Integer copper as gold, rounded half-up to two places.

    Where a copper is a whole number of hundredths of a gold the result is exact, and a decimal
    product costs a fraction of a decimal quotient and its rounding.
    """
    if 100 % rate == 0:
        return (copper * F.lit(Decimal(100 // rate).scaleb(-2))).cast(GOLD)
    return F.round(copper / F.lit(Decimal(f"{rate}.0")), 2).cast(GOLD)


def safe_divide(numerator: Column, denominator: Column, default: Column | None = None) -> Column:
    """``numerator / denominator``; ``default`` replaces a NULL result of any cause."""
    ratio = numerator / F.nullif(denominator, F.lit(0))
    return ratio if default is None else F.coalesce(ratio, default)


def pct_change(current: Column, previous: Column) -> Column:
    """Relative change to four places; NULL when the previous value is zero."""
    return F.round((current - previous) / F.nullif(previous, F.lit(0)).cast("double"), 4)


def bucket_amount(amount: Column, low: float, high: float) -> Column:
    """``high`` / ``medium`` / ``low`` by threshold; ``none`` for NULL, zero or negative."""
    return (
        F.when(amount >= high, "high").when(amount >= low, "medium").when(amount > 0, "low").otherwise("none")
    )


def days_between(start: Column, end: Column) -> Column:
    """Midnights crossed from ``start`` to ``end`` (not elapsed 24-hour periods)."""
    return F.datediff(end, start)


def is_weekend(at: Column) -> Column:
    """True on Saturday and Sunday; Spark numbers them 7 and 1."""
    return F.dayofweek(at).isin(1, 7)


def period_start(at: Column, unit: str) -> Column:
    """First instant of the month, quarter or year, without passing through a time zone."""
    if unit not in ("month", "quarter", "year"):
        raise ValueError(f"no period {unit!r}; month, quarter or year")
    return F.trunc(at.cast("date"), unit).cast("timestamp_ntz")


def exact_avg(amount: Column) -> Column:
    """Mean of a decimal as one division of its exact sum, so task order cannot change it."""
    return F.sum(amount).cast("double") / F.nullif(F.count(amount), F.lit(0))
