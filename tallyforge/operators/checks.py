"""Data-quality operators. Each yields one row per check with the number of failures."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class NotNull:
    """Fails on every row in which the column is NULL."""

    column: str
    name = "not_null"

    @property
    def label(self) -> str:
        return self.column

    def failing(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class AcceptedValues:
    """Fails on every row whose value is not listed; NULL passes."""

    column: str
    values: tuple[str, ...]
    name = "accepted_values"

    @property
    def label(self) -> str:
        return self.column

    def failing(self) -> Column:
        return ~F.col(self.column).isin(*self.values)


@dataclass(frozen=True)
class Unique:
    """Fails on every non-null value (or combination of values) that occurs more than once."""

    columns: tuple[str, ...]

    @property
    def name(self) -> str:
        return "unique" if len(self.columns) == 1 else "unique_combination"

    @property
    def label(self) -> str:
        return ",".join(self.columns)

    def repeats(self, occurrences: Column) -> Column:
        """Whether a group of equal values fails; NULL counts as a value only in a combination."""
        repeated = occurrences > 1
        return repeated & F.col(self.columns[0]).isNotNull() if len(self.columns) == 1 else repeated


@dataclass(frozen=True)
class Relationship:
    """Fails on every child row whose non-null key is missing from the parent table."""

    column: str
    parent: str
    parent_column: str
    name = "relationships"

    @property
    def label(self) -> str:
        return self.column

    def failures(self, child: DataFrame, parent: DataFrame) -> DataFrame:
        return orphans(child, self.column, parent, self.parent_column).agg(
            F.coalesce(F.sum("child_rows"), F.lit(0)).alias("failures")
        )


Check = NotNull | AcceptedValues | Unique | Relationship


def repeated_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values occurring more than once, with their row counts.

    A single column ignores NULL; in a combination NULL counts as a value.
    """
    rows = df.select(*columns)
    if len(columns) == 1:
        rows = rows.filter(F.col(columns[0]).isNotNull())
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("occurrences")).filter("occurrences > 1")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child key values missing from the parent, with their row counts.

    Child rows are counted per key first, so a hot key reaches the join as one row.
    """
    keys = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("key"))
        .agg(F.count(F.lit(1)).alias("child_rows"))
    )
    return keys.join(parent.select(F.col(parent_column).alias("key")), "key", "left_anti")


def require_unique(df: DataFrame, columns: Sequence[str]) -> None:
    """Raise when a key whose columns are all non-null repeats."""
    complete = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns))
    sample = repeated_keys(df.filter(complete), columns).limit(5).collect()
    if sample:
        raise ValueError(f"key {tuple(columns)} repeats, e.g. {[tuple(row) for row in sample]}")


def duplicate_audit(df: DataFrame, key: str) -> DataFrame:
    """Row count, distinct key count and their difference."""
    counted = df.agg(F.count(F.lit(1)).alias("total_rows"), F.countDistinct(key).alias("distinct_ids"))
    return counted.withColumn("duplicates", F.col("total_rows") - F.col("distinct_ids"))


def run_checks(
    tables: dict[str, DataFrame], checks: dict[str, Sequence[Check]], tasks: dict[str, int] | None = None
) -> DataFrame:
    """Run every check: (table_name, check_name, column_name, failures).

    One pass per table serves its row-wise checks and its first uniqueness check; a further
    uniqueness check, and each relationship, is a pass of its own.

    ``tasks`` names tables that are themselves grouped by their key, and how many tasks count them.
    Otherwise the tasks that make the groups count them too, and hold every key several times over.
    """
    results = []
    for table, wanted in checks.items():
        df = tables[table]
        rowwise = [c for c in wanted if isinstance(c, (NotNull, AcceptedValues))]
        unique = [c for c in wanted if isinstance(c, Unique)]
        related = [c for c in wanted if isinstance(c, Relationship)]
        if rowwise or unique:
            parts = (tasks or {}).get(table, 1) if unique else 1
            dealt = df.repartition(parts, *unique[0].columns) if parts > 1 else df
            results.append(_one_pass(table, dealt, rowwise, unique[0] if unique else None))
        results += [_one_pass(table, df, [], check) for check in unique[1:]]
        results += [_lines(table, [c], c.failures(df, tables[c.parent]), ["failures"]) for c in related]
    while len(results) > 1:  # in pairs, as every union analyses all of its inputs again
        results = [reduce(DataFrame.unionByName, results[i : i + 2]) for i in range(0, len(results), 2)]
    return results[0]


def _one_pass(table: str, df: DataFrame, rowwise: Sequence[Check], unique: Unique | None) -> DataFrame:
    """Failures of row-wise checks and at most one uniqueness check.

    With a uniqueness check the row-wise counts ride along its grouping: they are summed per
    key before the shuffle and over all keys after it.
    """
    names = [f"c{i}" for i in range(len(rowwise))]
    counts = [F.count_if(check.failing()).alias(name) for check, name in zip(rowwise, names)]
    if unique is None:
        return _lines(table, rowwise, df.agg(*counts), names)
    per_key = df.groupBy(*unique.columns).agg(F.count(F.lit(1)).alias("occurrences"), *counts)
    totals = per_key.agg(
        F.count_if(unique.repeats(F.col("occurrences"))).alias("repeats"),
        *(F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in names),
    )
    return _lines(table, [unique, *rowwise], totals, ["repeats", *names])


def _lines(table: str, checks: Sequence[Check], counts: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row of counts as one line per check."""
    lines = ", ".join(
        f"struct('{table}' AS table_name, '{check.name}' AS check_name, '{check.label}' AS column_name, "
        f"{name} AS failures)"
        for check, name in zip(checks, names)
    )
    return counts.selectExpr(f"inline(array({lines}))")


def unlisted_values(df: DataFrame, column: str, listed: Sequence[str]) -> DataFrame:
    """Drift guard for a declared value list: the unlisted values and their row counts."""
    return (
        df.filter(~F.col(column).isin(*listed))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
