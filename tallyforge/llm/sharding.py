"""Sharding by longest processing time: equal texts stay together, shard sizes come out near equal.

Groups are sorted by size and each goes to the shard with the least bytes so far, taken from a
heap. The heap sees them as a histogram: how many groups there are of each size, sizes told apart by
their leading SIZE_BITS bits, which makes exact sizes up to 2 KB and steps below a thousandth beyond. That is at
most 2**(SIZE_BITS - 1) steps for each doubling of the size, however many documents there are. Groups of a step go in
turn to the least loaded shards until these have caught up with the others, and round by round
from there on, so a step is scheduled as a few runs of ranks; a group's rank within its step, in hash order, gives its shard.

A NULL text has no bytes and is grouped with the empty text. NULL ids are kept as they are.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.rows import ROW, attach, hash_chunk, located, scan_row, total_before
from tallyforge.sources.storage import materialize

SHARDS = 8
SIZE_BITS = 11


def longest_first(steps: Iterable[tuple[int, int, int]], shards: int) -> Iterator[tuple[int, int, int, list[int]]]:
    """Longest-first places of groups: ``steps`` are (step, groups, bytes), a step's groups of like size.

    Gives (step, first rank, ranks, shards): the ranks from the first on go to the shards in turn.
    """
    heap = [(0.0, shard) for shard in range(shards)]
    for step, groups, size in sorted(steps, reverse=True):
        each, rank = size / groups, 0
        while rank < groups:
            load, shard = heap[0]
            if groups - rank >= shards and max(heap)[0] - load < each:
                # All shards lie within one group: whole rounds, in the order of their loads.
                rounds, order = (groups - rank) // shards, sorted(heap)
                yield step, rank, rounds * shards, [shard for _, shard in order]
                heap = [(load + rounds * each, shard) for load, shard in order]
                rank += rounds * shards
                continue
            heapq.heappop(heap)
            # As many as this shard takes until another one has less, one at least.
            wanted = math.ceil((heap[0][0] - load) / each) if heap else groups
            taken = min(groups - rank, max(1, wanted))
            yield step, rank, taken, [shard]
            heapq.heappush(heap, (load + taken * each, shard))
            rank += taken


def size_step(size: str) -> Column:
    """The step of a size: its leading SIZE_BITS bits, below how many bits follow them."""
    cut = f"greatest(length(bin({size})) - {SIZE_BITS}, 0)"
    return F.expr(f"shiftleft({cut}, {SIZE_BITS}) + shiftright({size}, {cut})")


def assign_groups(groups: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``groups`` (``group``, ``bytes``) with the shard of each."""
    spark = groups.sparkSession
    stepped = materialize(
        groups.select(
            "group",
            "bytes",
            size_step("bytes").cast("long").alias("step"),
            F.xxhash64("group").alias("position"),
            F.lit(1).cast("long").alias("one"),
        )
    )
    # At most 2**(SIZE_BITS - 1) steps for each doubling of the size.
    counted = stepped.groupBy("step").agg(F.count(F.lit(1)).alias("groups"), F.sum("bytes").alias("bytes")).collect()
    runs = longest_first(((row["step"], row["groups"], row["bytes"]) for row in counted), shards)
    schema = "step long, first long, ranks long, turn array<int>"
    table = F.broadcast(spark.createDataFrame(list(runs), schema))
    order = [F.shiftrightunsigned("position", 1), F.col("group")]
    ranked = total_before(stepped, ["step"], hash_chunk(F.col("position"), stepped.count()), order, "one", "rank")
    placed = ranked.join(table, "step").filter((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("ranks")))
    turn = F.pmod(F.col("rank") - F.col("first"), F.size("turn")).cast("int")
    return placed.select("group", F.get("turn", turn).alias("shard"))


def sized_rows(docs: DataFrame, text: str = "text", key: str = "doc_id", row: Column | None = None) -> DataFrame:
    """One narrow row per document, written out: position (``row``), id, bytes, checksum and group."""
    value = F.coalesce(F.col(text), F.lit(""))
    return materialize(
        docs.select(
            (scan_row() if row is None else row).alias(ROW),
            F.col(key).alias("key"),
            (F.octet_length(value) + 1).cast("long").alias("size"),
            F.crc32(value.cast("binary")).alias("text_crc32"),
            F.unhex(F.md5(value.cast("binary"))).alias("group"),
        )
    )


def shard_rows(sized: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``sized`` with ``shard`` and a gapless ``slot`` within it, in shuffled order."""
    groups = sized.groupBy("group").agg(F.sum("size").alias("bytes"))
    placed = sized.join(assign_groups(groups, shards), "group")
    placed = materialize(
        placed.select(ROW, "key", "size", "text_crc32", "shard", F.xxhash64("key", "group").alias("position"))
        .withColumn("one", F.lit(1).cast("long"))
    )
    chunk = hash_chunk(F.col("position"), placed.count())
    order = [F.shiftrightunsigned("position", 1), F.col("key"), F.col("size")]
    return total_before(placed, ["shard"], chunk, order, "one", "slot").drop("position", "one")


def shard_report(docs: DataFrame) -> DataFrame:
    placed = shard_rows(sized_rows(docs))
    return placed.select(
        F.col("key").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def sharded_documents(docs: DataFrame) -> DataFrame:
    """The documents with their shard and slot.

    Columns of the input called ``shard`` or ``slot`` are replaced.
    """
    whole = located(docs)
    placed = attach(whole, shard_rows(sized_rows(whole, "row.text", "row.doc_id", F.col(ROW))).select(ROW, "shard", "slot"))
    kept = [f"row.`{name}`" for name in docs.columns if name not in ("shard", "slot")]
    return placed.select(*kept, "shard", "slot")
