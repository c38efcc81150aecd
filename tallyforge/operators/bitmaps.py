"""Distinct counts that merge: bitmaps of ids per group, stored once and added up to coarser groups.

Counts of distinct ids cannot be summed, bitmaps can be united. An id is a bit in the bitmap of its
bucket of 32,768 ids, so a group holds one row per bucket that it has ids in.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

BUCKET, BITS = "id_bucket", "id_bits"


def distinct_bitmaps(df: DataFrame, groups: Sequence[str], ids: str) -> DataFrame:
    """The ids of each group as bitmaps; NULL ids are not counted.

    Ids are whole numbers. Appending the bitmaps of further rows of a group is enough to add them.
    """
    if not isinstance(df.schema[ids].dataType, IntegralType):
        raise TypeError(f"{ids} is {df.schema[ids].dataType.simpleString()}, bitmaps need whole numbers")
    known = df.filter(F.col(ids).isNotNull())
    return known.groupBy(*groups, F.bitmap_bucket_number(ids).alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(ids)).alias(BITS)
    )


def distinct_counts(bitmaps: DataFrame, groups: Mapping[str, Column], name: str) -> DataFrame:
    """Exact distinct ids per coarser group, each an expression over the stored groups."""
    merged = bitmaps.groupBy(*(made.alias(group) for group, made in groups.items()), BUCKET).agg(
        F.bitmap_or_agg(BITS).alias(BITS)
    )
    return merged.groupBy(*groups).agg(F.sum(F.bitmap_count(BITS)).alias(name))
