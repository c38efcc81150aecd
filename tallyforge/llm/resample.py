"""Importance resampling towards a target distribution.

Hashed word runs make two histograms, one of the corpus and one of the target texts. A bucket's
gain is the logarithm of the ratio of its smoothed shares, as a whole number; the gains are an
array that every document's buckets index, and the sum is its weight. Gumbel noise from the
document id turns "the highest scores" into a draw without replacement by these weights.

The lowest drawn score is found without sorting the corpus: a quantile sketch gives a bracket
around it, exact counts of the rows outside tell whether the place sought lies inside, the bracket
widens until it does, and only the bracket is sorted. The drawn rows are then ranked in one
distributed sort.

NULL text has no words, so weight 0. Documents with too few words get a score and no rank. A NULL id
takes the noise of the empty id and comes after all others among equal scores. Rows equal in score
and id are told apart by their position in the scored table, any of them first. An empty corpus or
target is a histogram of zeros.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from tallyforge.llm.rows import ROW, attach, located, scan_row
from tallyforge.llm.words import map_column
from tallyforge.sources.storage import materialize

#: Words of lower-cased UTF-8: letters and digits of ASCII, and everything beyond ASCII.
find_words = re.compile(rb"[0-9a-z\x80-\xff]+").findall
#: Rows of one task under monotonically_increasing_id.
TASK_BITS = 33


@dataclass(frozen=True)
class Resampling:
    """Runs of 1 to ``longest`` words in ``buckets`` buckets; ``percent`` of those with ``least_words`` are drawn."""

    longest: int = 1
    buckets: int = 10_000
    percent: int = 10
    least_words: int = 20
    seed: int = 2024
    #: Sketch accuracy, and half the bracket's first width as a share of the rows.
    accuracy: int = 10_000
    margin: float = 0.001


class Buckets(dict):
    """The bucket of a run of words, remembered for a fixed number of runs."""

    LIMIT = 1 << 18

    def __init__(self, count: int) -> None:
        self.count = count

    def __missing__(self, run: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        self[run] = bucket = zlib.crc32(run) % self.count
        return bucket


def bucket_lists(text: str | None, longest: int, buckets: Buckets) -> Iterator[np.ndarray]:
    """Buckets of all runs of one word, of two, and so on: one array per length."""
    words = find_words((text or "").encode().lower())
    for length in range(1, longest + 1):
        runs = words if length == 1 else map(b" ".join, zip(*(words[start:] for start in range(length))))
        yield np.fromiter(map(buckets.__getitem__, runs), np.int64)


def histogram(texts: DataFrame, rule: Resampling, text: str = "text") -> np.ndarray:
    """Features per bucket over all texts: one number per bucket, however large the input."""
    longest, size = rule.longest, rule.buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, counts, used = Buckets(size), np.zeros(size, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            values = batch.column(0).to_pylist()
            found = [each for value in values for each in bucket_lists(value, longest, buckets)]
            counts += np.bincount(np.concatenate(found or [used]), minlength=size)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["bucket", "features"])

    parts = texts.select(F.col(text).alias("text")).mapInArrow(run, "bucket long, features long")
    counts = np.zeros(size, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("features").alias("features")).collect():
        counts[row["bucket"]] = row["features"]
    return counts


def gains(corpus: Sequence[int], target: Sequence[int]) -> np.ndarray:
    """Per bucket the logarithm of target share over corpus share in thousandths, rounded down."""
    corpus, target = [float(n) for n in corpus], [float(n) for n in target]
    size, all_corpus, all_target = len(corpus), sum(corpus), sum(target)
    found = [
        math.floor(1000 * math.log((t + 1) * (all_corpus + size) / ((s + 1) * (all_target + size))))
        for s, t in zip(corpus, target)
    ]
    return np.array(found, np.int64)


def noise(key: Column, seed: int) -> Column:
    """Gumbel noise of an id in thousandths, the same on every run."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    digits = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.ln(-F.ln((digits + 0.5) / 4294967296.0)))


def scored_rows(
    docs: DataFrame,
    target: DataFrame,
    rule: Resampling,
    text: str = "text",
    key: str = "doc_id",
    row: Column | None = None,
    target_text: str = "text",
) -> DataFrame:
    """One narrow row per document, written out: position, id, words, features, weight and score."""
    gain = gains(histogram(docs, rule, text), histogram(target, rule, target_text))
    longest, size = rule.longest, rule.buckets

    def weigh(texts: list) -> list[list]:
        buckets, made = Buckets(size), [[], [], []]
        for value in texts:
            lists = list(bucket_lists(value, longest, buckets))
            found = len(lists[0]), sum(map(len, lists)), sum(int(gain[each].sum()) for each in lists)
            for column, number in zip(made, found):
                column.append(number)
        return made

    narrow = docs.select(
        (scan_row() if row is None else row).alias(ROW), F.col(key).alias("key"), F.col(text).alias("text")
    )
    fields = [StructField(name, LongType()) for name in ("n_words", "n_features", "weight")]
    weighed = map_column(narrow, "text", fields, weigh)
    return materialize(weighed.withColumn("score", F.col("weight") + noise(F.col("key"), rule.seed)))


def _order() -> list[Column]:
    return [F.desc("score"), F.asc_nulls_last("key"), F.asc(ROW)]


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``rank`` from 1, highest score first, by one distributed sort.

    Sorted rows are written with their task and place in it; a task's rows come after those of all
    tasks before it. Only the row counts of the tasks meet in one place.
    """
    placed = materialize(rows.orderBy(*_order()).withColumn("_place", F.monotonically_increasing_id()))
    task = F.shiftright("_place", TASK_BITS)
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(task.alias("_task"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_task", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    joined = placed.withColumn("_task", task).join(F.broadcast(offsets), "_task")
    within = F.col("_place").bitwiseAND(F.lit((1 << TASK_BITS) - 1))
    return joined.withColumn("rank", F.col("_offset") + within + 1).drop("_place", "_task", "_offset")


def bracket(scores: DataFrame, place: int, rows: int, rule: Resampling) -> tuple[int, int, int]:
    """Lowest and highest score of a bracket that holds the ``place``-th highest, and the rows above it.

    The sketch only proposes; the exact counts decide. From a margin of 1 on, the bracket is
    everything.
    """
    margin, middle = rule.margin, 1 - place / rows
    while True:
        ends = F.percentile_approx("score", [max(0.0, middle - margin), min(1.0, middle + margin)], rule.accuracy)
        lowest, highest, (low, high) = scores.agg(F.min("score"), F.max("score"), ends).first()
        if margin >= 1:
            low, high = lowest, highest
        above, inside = scores.agg(
            F.count_if(F.col("score") > high), F.count_if(F.col("score").between(low, high))
        ).first()
        if above < place <= above + inside:
            return low, high, above
        margin *= 4


def drawn(scored: DataFrame, rule: Resampling) -> Column | None:
    """Which rows of ``scored`` are drawn; None if none is."""
    able = scored.filter(F.col("n_words") >= rule.least_words)
    rows = able.count()
    place = rule.percent * rows // 100
    if place == 0:
        return None
    low, high, above = bracket(able, place, rows, rule)
    inside = able.filter(F.col("score").between(low, high)).select("score", "key", ROW)
    last = ranked(inside).filter(F.col("rank") == place - above).first()
    score, row = F.lit(last["score"]), F.col(ROW) <= last[ROW]
    if last["key"] is None:
        tied = F.col("key").isNotNull() | row
    else:
        key = F.lit(last["key"])
        tied = F.coalesce((F.col("key") < key) | ((F.col("key") == key) & row), F.lit(False))
    in_front = (F.col("score") > score) | ((F.col("score") == score) & tied)
    return (F.col("n_words") >= rule.least_words) & in_front


def resample(scored: DataFrame, rule: Resampling) -> DataFrame:
    """``scored`` with the ``rank`` of every drawn row, NULL for the others."""
    chosen = drawn(scored, rule)
    without = F.lit(None).cast("long").alias("rank")
    if chosen is None:
        return scored.select("*", without)
    return scored.filter(~chosen).select("*", without).unionByName(ranked(scored.filter(chosen)))


def resampling_report(docs: DataFrame, target: DataFrame, rule: Resampling = Resampling()) -> DataFrame:
    found = resample(scored_rows(docs, target, rule), rule)
    return found.select(F.col("key").alias("doc_id"), "n_features", "weight", "score", "rank")


def resampled_documents(docs: DataFrame, target: DataFrame, rule: Resampling = Resampling()) -> DataFrame:
    """The drawn documents, whole, in no order."""
    whole = located(docs)
    scored = scored_rows(whole, target, rule, "row.text", "row.doc_id", F.col(ROW))
    chosen = drawn(scored, rule)
    kept = scored.filter(F.lit(False) if chosen is None else chosen)
    return attach(whole, kept.select(ROW)).select("row.*")
