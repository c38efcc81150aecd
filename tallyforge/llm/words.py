"""Words, letter case and Arrow plumbing shared by the operators."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType

#: A word: no space and none of the control characters tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
find_words = re.compile(WORD).findall


def lower_ascii(text: str) -> str:
    """Lower-case A to Z only."""
    return text.encode().lower().decode()


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a fixed number."""

    LIMIT = 1 << 18

    def __missing__(self, word: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = code = xxhash.xxh3_64_intdigest(word)
        return code

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def map_column(
    df: DataFrame, column: str, fields: list[StructField], compute: Callable[[list], list[list]], keep_column: bool = False
) -> DataFrame:
    """Replace ``column`` by ``fields``, computed from its values one Arrow batch at a time.

    ``compute`` gets the values of a batch (None for NULL) and returns one list per field. The
    other columns pass through as Arrow arrays, so NULLs and wide integers stay as they are.
    """
    kept = [field for field in df.schema if keep_column or field.name != column]
    schema = StructType(kept + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(field.dataType) for field in fields]
        for batch in batches:
            made = compute(batch.column(column).to_pylist())
            arrays = [batch.column(field.name) for field in kept]
            arrays += [pa.array(values, type=kind) for values, kind in zip(made, types)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return df.mapInArrow(run, schema)
