"""Incremental loads of a published table, by a high-water mark on a timestamp column."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.sources.published import PublishedTable


def high_water_mark(table: PublishedTable, at: str) -> datetime | None:
    """The latest value of ``at`` in the table; None when there is none.

    A table whose partitions are ordered by ``at`` is read from the last one back, so usually one
    is scanned. Any other partitioning says nothing about ``at``, and the whole column is read.
    """
    parts = [part for part in reversed(table.partitions()) if part != "none"]
    for selection in ([part] for part in parts) if table.ordered_by == at else [None]:
        mark = table.read(selection).agg(F.max(at)).first()[0]
        if mark is not None:
            return mark
    return None


def newer_rows(
    source: DataFrame, at: str, mark: datetime | None, lookback: timedelta = timedelta(0)
) -> DataFrame:
    """Source rows from the mark on, the boundary included; all rows when there is no mark.

    The mark is a literal, so the filter reaches the scan of a typed column. Ties at the mark
    are read again. Older rows, and rows without a timestamp, are not; ``lookback`` widens the
    window for rows that land late.
    """
    if mark is None:
        return source
    start = F.lit((mark - lookback).isoformat(sep=" ")).cast("timestamp_ntz")
    return source.filter(F.col(at) >= start)


def possibly_newer(source: DataFrame, raw_at: str, mark: datetime | None, lookback: timedelta = timedelta(0)) -> DataFrame:
    """Rows whose raw time text can parse to the window's first day or later; the scan filters too.

    Both accepted shapes start with the ISO date after optional blanks, so text that sorts before
    that date is older, unless it starts with something below a digit, such as a blank. Text of
    other shapes passes or has no time at all. The exact filter on the parsed time follows.
    """
    if mark is None:
        return source
    day = (mark - lookback).date().isoformat()
    return source.filter((F.col(raw_at) >= day) | (F.col(raw_at) < "0"))


def load(
    table: PublishedTable,
    source: DataFrame,
    at: str,
    keys: Sequence[str],
    lookback: timedelta = timedelta(0),
    full_refresh: bool = False,
) -> None:
    """One run: upsert the newer rows by key, or rebuild on the first run or a full refresh."""
    if not keys:
        raise ValueError("an incremental load needs at least one key column")
    if full_refresh or not table.exists():
        return table.replace(source)
    mark = high_water_mark(table, at)
    table.upsert(newer_rows(source, at, mark, lookback), keys)


def load_keyless(table: PublishedTable, source: DataFrame, at: str) -> None:
    """One run without a key: newer rows are appended, so boundary rows duplicate every time."""
    if not table.exists():
        return table.replace(source)
    mark = high_water_mark(table, at)
    table.append(newer_rows(source, at, mark))
