"""Vector columns as matrices, one Arrow batch at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def common_length(df: DataFrame, vector: str) -> int:
    """The length that most vectors have, the longer of two equally common ones; 0 without vectors."""
    sizes = df.filter(F.col(vector).isNotNull()).groupBy(F.size(vector).alias("length")).count()
    # A table of lengths, of which one row is taken.
    found = sizes.orderBy(F.desc("count"), F.desc("length")).first()
    return found["length"] if found else 0


def finite_rows(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and values, as doubles, of the vectors of ``length`` finite entries."""
    sized = np.asarray(pc.fill_null(pc.list_value_length(column), -1)) == length
    flat = column.filter(pa.array(sized)).flatten().to_numpy(zero_copy_only=False)
    values = flat.astype(np.float64).reshape(-1, max(1, length))
    finite = np.isfinite(values).all(axis=1)
    return np.flatnonzero(sized)[finite], values[finite]
