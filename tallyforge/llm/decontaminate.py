"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The test strings are the word windows of the benchmark items. For all strings of one length,
a block of two words has a shift: how far the window may move when its last two words are that
block. Unknown blocks move it by almost its length, so clean text is mostly skipped. Where the
shift is 0, the strings that end in this block are looked up and compared word by word.

The strings are broadcast in blocks of bounded size; a larger benchmark takes several passes
over the same rows in one task, each adding to the words hit so far. Of a block's text a worker
holds the words in one list and the tables as arrays of places in it.

NULL texts have no words. Items without words match nothing. An item with fewer words than the
window is one string of its own length. Items that share an id count once; the words of items
without an id are hit, but such items are neither counted nor listed.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from tallyforge.llm.words import lower_ascii

WINDOW = 13
#: Multiplier of the first word's code in a block's slot.
MIX = 31
#: Text of benchmark items that is broadcast at once; its tables take about ten times as much of a worker's memory.
BLOCK_BYTES = 8 << 20

_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def bench_words(text: str | None) -> list[str]:
    """Lower-cased runs of ASCII letters, digits and non-ASCII characters."""
    return _WORDS.findall(lower_ascii(text)) if text else []


class Strings:
    """Search tables for strings of one length, all arrays; strings are places in one list of words.

    ``shifts`` has a byte per hash of a block, the least shift of the blocks that share it, so a
    collision only shortens a move. ``slots`` and ``ends`` list where strings end, by the hash of their last block.
    """

    def __init__(self, length: int, words: list[str], spans: Sequence[tuple[int, int, str | None]]) -> None:
        self.length, self.words, self.block = length, words, min(2, length)
        self.longest = length - self.block + 1
        self.starts = np.array([start for start, _, _ in spans], np.int64)
        self.items = [item for _, _, item in spans]
        sizes = np.array([end - start - self.block + 1 for start, end, _ in spans], np.int64)
        self.mask = (1 << max(8, (8 * int(sizes.sum())).bit_length())) - 1
        # Ends of the blocks, and how far into its item each reaches.
        reach = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + self.block
        ends = np.repeat(self.starts, sizes) + reach
        codes = np.fromiter(map(hash, words), np.int64, len(words))
        slots = codes[ends - 1] + (MIX * codes[ends - 2] if self.block == 2 else 0) & self.mask
        # A block that ends a string moves nothing; one nearer its item's start lies in the item's first string.
        shifts = np.full(self.mask + 1, min(255, self.longest), np.uint8)
        np.minimum.at(shifts, slots, np.clip(length - reach, 0, 255).astype(np.uint8))
        self.shifts = bytes(shifts)
        last = reach >= length
        order = np.argsort(slots[last], kind="stable")
        self.slots, self.ends = slots[last][order], ends[last][order]

    def occurrences(self, words: Sequence[str]) -> Iterator[tuple[int, set]]:
        """Start and items of each occurrence."""
        length, shifts, pairs, mask = self.length, self.shifts, self.block == 2, self.mask
        end, n = length, len(words)
        while end <= n:
            key = hash(words[end - 1]) + (MIX * hash(words[end - 2]) if pairs else 0) & mask
            shift = shifts[key]
            if shift:
                end += shift
                continue
            found = self.ending(key, words[end - length : end])
            if found:
                yield end - length, found
            end += 1

    def ending(self, slot: int, string: list[str]) -> set:
        """Items with this string, compared word by word with the strings whose last block has the slot."""
        first, last = np.searchsorted(self.slots, [slot, slot + 1]).tolist()
        found = set()
        for end in self.ends[first:last].tolist():
            if self.words[end - self.length : end] == string:
                found.add(self.items[int(np.searchsorted(self.starts, end, side="left")) - 1])
        return found


def build_tables(items: Iterable[tuple[str | None, str | None]], window: int = WINDOW) -> list[Strings]:
    """Search tables of ``(item id, text)`` pairs, one per string length."""
    words: dict[int, list[str]] = defaultdict(list)
    spans: dict[int, list[tuple[int, int, str | None]]] = defaultdict(list)
    known: dict[str, str] = {}
    for item, text in items:
        own = bench_words(text)
        if own:
            length = min(window, len(own))
            begin = len(words[length])
            # Every distinct word is held once.
            words[length] += [known.setdefault(word, word) for word in own]
            spans[length].append((begin, begin + len(own), item))
    return [Strings(length, words[length], spans[length]) for length in words]


def hits(words: Sequence[str], tables: Sequence[Strings]) -> tuple[list[tuple[int, int]], set]:
    """Word spans covered by any string, merged and in order, and the items found."""
    spans, items = [], set()
    for table in tables:
        for start, found in table.occurrences(words):
            spans.append((start, start + table.length))
            items |= found
    return merge_spans(spans), items


def merge_spans(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[list[int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    return [(start, end) for start, end in merged]


_SPANS = ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())]))
HITS = StructType(
    [
        StructField("n_words", IntegerType()),
        StructField("spans", _SPANS),
        StructField("items", ArrayType(StringType())),
    ]
)
_ARROW_HITS = pa.struct(
    [
        ("n_words", pa.int32()),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
        ("items", pa.list_(pa.string())),
    ]
)


def _blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> Iterator[list[tuple]]:
    """The benchmark's rows in blocks of about ``block_bytes`` of text, one at a time."""
    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes) or 1
    for block in range(blocks):
        part = rows if blocks == 1 else rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        yield [(row["item"], row["text"]) for row in part.toLocalIterator()]


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    keep_text: bool = True,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with a column ``hits``: word count, merged hit spans in words, and item ids found."""
    found = docs.withColumn("hits", F.lit(None).cast(HITS))
    for rows in _blocks(benchmark, item_id, item_text, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(rows)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            tables = build_tables(shared.value, window)
            for batch in batches:
                made = []
                for value, before in zip(batch.column(text).to_pylist(), batch.column("hits").to_pylist()):
                    words = bench_words(value)
                    spans, items = hits(words, tables)
                    if before:
                        spans = merge_spans(spans + [(s["start"], s["end"]) for s in before["spans"]])
                        items |= set(before["items"])
                    made.append(
                        {
                            "n_words": len(words),
                            "spans": [{"start": start, "end": end} for start, end in spans],
                            "items": sorted(items, key=lambda name: (name is None, name)),
                        }
                    )
                arrays = [batch.column(name) for name in batch.schema.names if name != "hits"]
                names = [name for name in batch.schema.names if name != "hits"]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(made, type=_ARROW_HITS)], names=[*names, "hits"])

        found = found.mapInArrow(search, found.schema)
    return found if keep_text else found.drop(text)


def _is_contaminated(words, n_hit):
    return (n_hit > 0) & (20 * n_hit >= words)


def _n_hit():
    return F.aggregate(
        "hits.spans", F.lit(0).cast("long"), lambda total, span: total + (span["end"] - span["start"]).cast("long")
    )


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document its words, hit words, items found with their digest, and the verdict."""
    found = find_contamination(docs.select("doc_id", "text"), benchmark, keep_text=False)
    items = F.filter("hits.items", lambda name: name.isNotNull())
    counted = found.select(
        "doc_id",
        F.col("hits.n_words").cast("long").alias("n_words"),
        _n_hit().alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
    )
    return counted.withColumn("contaminated", _is_contaminated(F.col("n_words"), F.col("n_hit")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their columns as they are."""
    staged = docs.select(F.struct("*").alias("row"), F.col("text").alias("searched_text"))
    found = find_contamination(staged, benchmark, text="searched_text", keep_text=False)
    clean = ~_is_contaminated(F.col("hits.n_words"), _n_hit())
    return found.filter(clean).select("row.*")
