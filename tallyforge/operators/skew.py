"""Equi-joins in which a few key values hold most of the rows of one side.

Spark splits an oversized join partition at run time, but not on the right of a left join
and not when a later step needs the join's partitioning. Here the hot keys are measured
first, in one map-side pass, and only those are spread over several tasks. Every row still
takes part in the join.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

SALT = "_salt"
COPIES = "_copies"
#: Sampled rows that a key of two tasks can expect, and how many of them make it a hot key.
EXPECTED, SEEN = 128, 64
#: Share of the rows from which on all of them are counted.
WHOLE = 0.05
#: Bytes of a row where the size of a table is unknown.
ROW_BYTES = 100


@dataclass(frozen=True)
class HotKeys:
    """Keys of one column with the number of tasks each is spread over; NULL included."""

    column: str
    copies: dict

    def __bool__(self) -> bool:
        return bool(self.copies)


def hot_keys(df: DataFrame, columns: Sequence[str], total_bytes: float, task_bytes: int) -> list[HotKeys]:
    """Values of each column whose rows would fill two tasks of ``task_bytes`` or more.

    ``total_bytes`` is the size of ``df``; where it is not known (infinite) rows count as
    ``ROW_BYTES`` each. Rows are sampled so that a key of two tasks can expect ``EXPECTED`` of them, and
    counted by column and key: combined within each task, then shuffled by key, so no task's share grows with the
    number of tasks. The sample has ``EXPECTED`` rows per two tasks of input, however large the table.
    A key of two tasks stays below ``SEEN`` sampled rows with probability under 1e-8, and is then
    left to adaptive execution. Shares are estimates; they only decide how a key is spread.
    """
    rows = df.count()
    if math.isinf(total_bytes):
        total_bytes = rows * ROW_BYTES
    if rows == 0 or total_bytes < 2 * task_bytes:
        return [HotKeys(column, {}) for column in columns]
    share = EXPECTED * total_bytes / (2 * task_bytes) / rows
    # Where a sample would be a good part of the table, all of it gives exact shares.
    share = 1.0 if share > WHOLE else share
    sampled = df.select(*columns) if share == 1 else df.select(*columns).sample(share, seed=1)
    named = F.explode(
        F.array(*(F.struct(F.lit(k).alias("column"), F.col(c).cast("string").alias("key")) for k, c in enumerate(columns)))
    )
    counted = sampled.select(named.alias("one")).groupBy("one.column", "one.key").count()
    per_task = task_bytes / total_bytes * rows * share
    hot = counted.filter(F.col("count") >= (2 * per_task if share == 1 else SEEN))
    found: list[dict] = [{} for _ in columns]
    # At most a key per task of input and column.
    for row in hot.collect():
        found[row["column"]][row["key"]] = math.ceil(row["count"] / per_task)
    kinds = [df.schema[column].dataType for column in columns]
    return [HotKeys(column, _typed(df, kind, keys)) for column, kind, keys in zip(columns, kinds, found)]


def _typed(df: DataFrame, kind, keys: dict) -> dict:
    """Keys cast back from text."""
    if isinstance(kind, StringType) or not keys:
        return keys
    texts = df.sparkSession.createDataFrame([(key,) for key in keys], "key string")
    return {row["value"]: keys[row["key"]] for row in texts.select("key", F.col("key").cast(kind).alias("value")).collect()}


def spread_join(
    many: DataFrame, one: DataFrame, key: str, how: str, hot: HotKeys | None, spread: Column
) -> DataFrame:
    """``many.join(one, key, how)`` for inner or left, with hot keys of ``many`` spread out.

    ``one`` has few rows per key; its hot rows are repeated once per task the key is spread
    over. ``spread`` is a long expression over ``many`` that varies within a key and does not
    change when a task is retried.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"spread_join is for inner and left joins, not {how!r}")
    if not hot:
        return many.join(one, key, how)
    salted = _with_copies(many, key, hot).withColumn(SALT, F.pmod(spread, F.col(COPIES))).drop(COPIES)
    return salted.join(_repeated(one, key, hot), [key, SALT], how).drop(SALT)


def spread_left_join(
    one: DataFrame, many: DataFrame, key: str, hot: HotKeys | None, spread: Column
) -> DataFrame:
    """``one.join(many, key, "left")`` with hot keys of ``many``, on the right, spread out.

    Matched rows come from the spread inner join. Left rows without a partner are found against
    the distinct keys, where a hot key is one row.
    """
    if not hot:
        return one.join(many, key, "left")
    matched = spread_join(many, one, key, "inner", hot, spread)
    alone = one.join(many.select(key).distinct(), key, "left_anti")
    columns = [key, *(c for c in one.columns + many.columns if c != key)]
    return matched.unionByName(alone, allowMissingColumns=True).select(*columns)


def _hot_frame(df: DataFrame, key: str, hot: HotKeys) -> DataFrame:
    schema = f"_hot_key {df.schema[key].dataType.simpleString()}, {COPIES} bigint"
    return df.sparkSession.createDataFrame(list(hot.copies.items()), schema)


def _with_copies(df: DataFrame, key: str, hot: HotKeys) -> DataFrame:
    """Add how many tasks the row's key is spread over. The hot list is bounded by its share."""
    frame = F.broadcast(_hot_frame(df, key, hot))
    marked = df.join(frame, F.col(key).eqNullSafe(F.col("_hot_key")), "left").drop("_hot_key")
    return marked.withColumn(COPIES, F.coalesce(F.col(COPIES), F.lit(1)))


def _repeated(df: DataFrame, key: str, hot: HotKeys) -> DataFrame:
    # NULL keys meet no partner, so they need no repeating.
    joinable = HotKeys(hot.column, {k: n for k, n in hot.copies.items() if k is not None})
    marked = _with_copies(df, key, joinable)
    tasks = F.sequence(F.lit(0).cast("bigint"), F.col(COPIES) - 1)
    return marked.withColumn(SALT, F.explode(tasks)).drop(COPIES)
