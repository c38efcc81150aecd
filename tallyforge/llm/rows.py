"""Row numbers and running totals without a task that sees a whole group.

A row is named by ``ROW``. In narrow tables that is its position in a scan; another scan of the
same files may cut and pack them otherwise, as when an executor joins or leaves, so positions of two
scans never meet: they are written once, and everything that is joined by them derives from those
files. To get whole documents back without writing them again, they are named by where they lie:
their file and their place in it (``located``), which no cutting changes.
"""

from __future__ import annotations

import math

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.sources.storage import materialize

ROW = "scan_row"
#: Rows that one task sorts when running totals are made.
CHUNK_ROWS = 1 << 16
#: Rows up to which a written table is broadcast; a larger one is joined by a shuffle.
BROADCAST_ROWS = 1 << 19


def scan_row() -> Column:
    return F.monotonically_increasing_id()


def located(docs: DataFrame) -> DataFrame:
    """``ROW``, 128 bits of hash of where a document lies, and the document as ``row``.

    Parquet files tell a row's place. Where ``docs`` is not a plain scan of such files it is written out first.
    """
    try:
        return _located(docs)
    except AnalysisException:
        return _located(materialize(docs))


def _located(docs: DataFrame) -> DataFrame:
    place = docs.metadataColumn("_metadata")
    name = F.md5(F.concat_ws("#", place["file_path"], place["row_index"]).cast("binary"))
    return docs.select(F.unhex(name).alias(ROW), F.struct("*").alias("row"))


def attach(whole: DataFrame, narrow: DataFrame) -> DataFrame:
    """The rows of ``whole`` (``located``) that ``narrow``, made from it, lists, with its other columns."""
    return whole.join(narrow, ROW).drop(ROW)


def hash_chunk(position: Column, rows: int) -> Column:
    """The leading bits of a 64-bit hash, as many as make chunks of about ``CHUNK_ROWS``."""
    bits = max(0, math.ceil(math.log2(max(1, rows) / CHUNK_ROWS)))
    return F.shiftrightunsigned(position, 64 - bits).cast("long") if bits else F.lit(0).cast("long")


def total_before(df: DataFrame, group: list[str], chunk: Column, order: list[Column], value: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of the same group that come earlier.

    ``chunk`` cuts each group into pieces that follow one another in ``order``. Pieces are
    summed, their sums run up, and only within a piece are rows sorted. ``df`` is read twice,
    so it should be a written table; ``group`` columns are not NULL.
    """
    cut = df.withColumn("_chunk", chunk)
    earlier = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*group, "_chunk")
        .agg(F.sum(value).alias("_sum"))
        .withColumn("_offset", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
        .drop("_sum")
    )
    inside = Window.partitionBy(*group, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = cut.withColumn("_local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = local.join(offsets, [*group, "_chunk"])
    return joined.withColumn(name, F.col("_offset") + F.col("_local")).drop("_chunk", "_offset", "_local")


def bounded(df: DataFrame, size: int | None = None) -> DataFrame:
    """``df``, a written table of narrow rows, marked for broadcast if ``size`` (its rows) is small."""
    return F.broadcast(df) if (df.count() if size is None else size) <= BROADCAST_ROWS else df
