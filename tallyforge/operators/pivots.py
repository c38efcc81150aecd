"""Pivots: one column per value of a category, from a declared or a discovered value list."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.conform import clean_token
from tallyforge.sources.storage import materialize


#: Columns that a pivot may have: a plan with many thousands is slow to make, and may fail.
MOST_COLUMNS = 2000


class TooManyValues(ValueError):
    """A pivot on more values than it may have columns; the same sums exist in rows."""


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The normalised values of a column, in order."""
    return df.select(clean_token(F.col(column)).alias(column)).distinct().orderBy(column)


def discover_values(df: DataFrame | None, column: str, fallback: Sequence[str]) -> list[str]:
    """The values to pivot on: those present, or ``fallback`` for a missing or empty table.

    Each becomes a column, so more than ``MOST_COLUMNS`` are an error; ``sums_in_rows`` gives the
    same for any number.
    """
    if df is None:
        return list(fallback)
    present = distinct_values(df, column).filter(F.col(column).isNotNull())
    return _bounded(present, column) or list(fallback)


def _bounded(values: DataFrame, column: str) -> list:
    """The values of an ordered column; no more than the bound and one reach the driver."""
    found = [row[0] for row in values.limit(MOST_COLUMNS + 1).collect()]
    if len(found) > MOST_COLUMNS:
        raise TooManyValues(f"{column} has more than {MOST_COLUMNS} values; keep them in rows")
    return found


def sums_in_rows(df: DataFrame, group: str, category: str, amount: str, name: str = "amount") -> DataFrame:
    """Sums of ``amount`` per group and category value, one row each: a pivot of any number of values."""
    return df.groupBy(group, category).agg(F.sum(amount).alias(name))


def sums_by_value(
    values: Sequence[str], category: Column, amount: Column, name: str, absent: int | None = None
) -> list[Column]:
    """One conditional sum per value, called ``name`` with ``{}`` filled in.

    ``absent`` is what other values contribute: 0 gives 0 for an absent value, None gives NULL.
    """
    names = [name.format(re.sub(" ", "_", value)) for value in values]
    if len(set(names)) != len(names):
        raise ValueError(f"two values share a column name: {sorted(names)}")
    return [
        F.sum(F.when(category == value, amount).otherwise(F.lit(absent))).alias(column)
        for value, column in zip(values, names)
    ]


def pivot_present_values(
    df: DataFrame, group: str, category: str, amount: str
) -> DataFrame:
    """Sums of ``amount`` per group, one column for each category value present in ``df``.

    The rows are aggregated to group and category once and stored; the column list is then
    read from that small result instead of running the whole input a second time.
    """
    sums = materialize(sums_in_rows(df, group, category, amount))
    values = _bounded(sums.select(category).distinct().orderBy(category), category)
    return sums.groupBy(group).pivot(category, values).agg(F.sum("amount"))
