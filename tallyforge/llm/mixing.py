"""Mixing sources to target weights with a low-discrepancy schedule.

The mix is a row of slots. Slot i has the point frac(i * golden ratio), and the points, mapped through
the sources' cumulative targets, say whose slot it is: every stretch of the mix holds every source in
proportion to its target, up to a few slots. A source that no point falls on gets one slot, at the place
frac(number * golden ratio) of the mix. A source's target is cut into as many blocks as it has slots,
equal within a word, and its r-th slot takes block r of its documents, laid end to end in shuffled
order, twice over at most. So every source gets its target, to the nearest word, however
small it is beside the others. The number of slots grows with the number of sources.

A source without a name is the last one. Documents without words (NULL text included) have size
0 and nothing is taken of them. Sources without words have target 0. Rows that are equal are
ranked in any order, which gives the same set of results.

DataFrame operations only.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.llm.rows import ROW, attach, bounded, hash_chunk, located, scan_row, total_before
from tallyforge.llm.words import WORD
from tallyforge.sources.storage import materialize

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: Words of the mix as a share of all words, and how often a document may be used.
SHARE, EPOCHS = 1.5, 2
MIN_SLOTS, SLOTS_PER_SOURCE = 1 << 16, 1 << 12
#: Slots that one task numbers.
SLOT_CHUNK = 1 << 12
GOLDEN = (math.sqrt(5) - 1) / 2
#: frac(2**16 * golden ratio), exact to a double: isqrt gives the digits.
HIGH_GOLDEN = ((math.isqrt(5 << 200) - (1 << 100)) << 15) % (1 << 100) / (1 << 100)


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def sized_rows(
    docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", row: Column | None = None
) -> DataFrame:
    """One narrow row per document, written out: position (``row``), id, source, words and shuffle hash."""
    return materialize(
        docs.select(
            (scan_row() if row is None else row).alias(ROW),
            F.col(key).alias("key"),
            F.col(source).alias("source"),
            word_count(text).alias("size"),
            F.xxhash64(key, text).alias("shuffle"),
        )
    )


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """Per source its number in code-point order, words and target.

    Targets follow the weights up to ``epochs`` times the source's words; what is above is
    shared among the others. With sources sorted by limit per weight, the words per weight left
    for the rest rise until the first source that stays below its limit, so the highest of them
    is the final one.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = sources.withColumn("number", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
    weight = F.get(F.array(*map(F.lit, weights)), F.pmod("number", F.lit(len(weights)))).cast("double")
    limit = (epochs * F.col("source_size")).cast("double")
    weighed = numbered.select("*", weight.alias("weight"), limit.alias("limit"))
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), "number")
    full_before = F.sum("limit").over(by_limit.rowsBetween(Window.unboundedPreceding, -1))
    weight_left = F.sum("weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wanted = share * F.sum("source_size").over(everything)
    level = (F.col("wanted") - F.coalesce(F.col("full_before"), F.lit(0.0))) / F.col("weight_left")
    return (
        weighed.select(
            "*", wanted.alias("wanted"), full_before.alias("full_before"), weight_left.alias("weight_left")
        )
        .withColumn("level", F.max(level).over(everything))
        .withColumn("target", F.least("limit", F.col("weight") * F.col("level")))
        .select("source", "number", "source_size", "target")
    )


def slot_count(targets: DataFrame) -> int:
    """Number of points."""
    sources, wanted = targets.agg(F.count(F.lit(1)), F.sum("target")).first()
    return min(max(MIN_SLOTS, SLOTS_PER_SOURCE * sources), math.ceil(wanted or 0))


def golden_point(number: Column) -> Column:
    """frac(number * golden ratio); the number in two parts, so that the product stays exact enough."""
    high, low = F.shiftright(number, 16), number.bitwiseAND(F.lit((1 << 16) - 1))
    point = high * HIGH_GOLDEN + low * GOLDEN
    return point - F.floor(point)


def schedule(spark: SparkSession, targets: DataFrame, slots: int, point: Callable[[Column], Column] = golden_point) -> DataFrame:
    """Slot, source number and rank of the slot among its source's slots, all from 0.

    There are ``slots`` of them, and one more for every source with a target of a word that no point falls on.
    """
    along = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("target").over(Window.orderBy("number").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    upto, total = F.sum("target").over(along), F.nullif(total, F.lit(0.0))
    shares = targets.select(
        "number", "target", ((upto - F.col("target")) / total).alias("low"), (upto / total).alias("high")
    ).filter("target > 0")
    # The last source's end is 1 up to rounding. Points and sources meet in cells, a few sources to each.
    ends = Window.orderBy(F.desc("number"))
    shares = materialize(shares.withColumn("high", F.when(F.row_number().over(ends) == 1, 2.0).otherwise(F.col("high"))))
    cells = 1 << max(10, math.ceil(math.log2(max(1, shares.count()))))
    reach = F.sequence(F.floor(F.col("low") * cells), F.floor(F.least("high", F.lit(1.0)) * cells))
    celled = shares.select("number", "low", "high", F.explode(reach).alias("cell"))
    points = spark.range(slots).select(F.col("id").alias("place"), point(F.col("id")).alias("point"))
    points = points.withColumn("cell", F.floor(F.col("point") * cells))
    inside = (F.col("point") >= F.col("low")) & (F.col("point") < F.col("high"))
    dealt = materialize(points.join(bounded(celled), "cell").filter(inside).select("number", F.col("place").cast("double").alias("place")))
    missed = shares.filter(F.round("target") >= 1).join(dealt.select("number").distinct(), "number", "left_anti")
    between = F.floor(golden_point(F.col("number").cast("long")) * slots) + 0.5
    whole = dealt.unionByName(missed.select("number", between.alias("place")))
    whole = materialize(whole.select("number", "place", F.lit(1).cast("long").alias("one"), F.lit(0).alias("mix")))
    chunk = F.floor(F.col("place") / SLOT_CHUNK)
    order = [F.col("place"), F.col("number")]
    ranked = materialize(total_before(whole, ["number"], chunk, order, "one", "rank"))
    return total_before(ranked, ["mix"], chunk, order, "one", "slot").select("slot", "number", "rank")


def blocks(sized: DataFrame, targets: DataFrame, planned: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """Which words of which rows make up block ``rank`` of each source's shuffled documents.

    A source's target, in words, is cut into as many blocks as ``planned`` has slots for it; the first ones
    have a word more where it does not divide.
    """
    counted = planned.groupBy("number").agg(F.count(F.lit(1)).alias("slots"))
    whole = F.round("target").cast("long")
    known = targets.join(counted, "number").select(
        F.col("source").alias("_source"), "number", "source_size", whole.alias("whole"), "slots"
    )
    rows = sized.filter("size > 0").join(known, F.col("source").eqNullSafe(F.col("_source")))
    passes = rows.select(
        ROW,
        "number",
        "source_size",
        "whole",
        "slots",
        "size",
        "key",
        "shuffle",
        F.explode(F.array(*map(F.lit, range(epochs)))).alias("epoch"),
    ).withColumn("position", F.xxhash64("shuffle", "epoch"))
    passes = materialize(passes)
    chunk = hash_chunk(F.col("position"), passes.count())
    # Chunks follow the hash as an unsigned number, and so does the order within a chunk.
    order = [F.shiftrightunsigned("position", 1), F.col("key"), F.col("size")]
    laid = total_before(passes, ["number", "epoch"], chunk, order, "size", "before")
    used = laid.withColumn("start", F.col("epoch") * F.col("source_size") + F.col("before")).filter("start < whole")
    used = used.withColumn("end", F.least(F.col("start") + F.col("size"), F.col("whole")))
    used = used.withColumns({"words": F.expr("whole div slots"), "longer": F.expr("whole % slots")})
    block = (
        "if({0} < longer * (words + 1), {0} div (words + 1), longer + ({0} - longer * (words + 1)) div greatest(words, 1))"
    )
    ranks = F.sequence(F.expr(block.format("start")), F.expr(block.format("(end - 1)")))
    begin = "({0} * words + least({0}, longer))"
    taken = F.expr(f"least(end, {begin.format('(rank + 1)')}) - greatest(start, {begin.format('rank')})")
    return used.select(ROW, "number", "start", "end", "words", "longer", F.explode(ranks).alias("rank")).select(
        ROW, "number", "rank", taken.alias("words")
    )


def mix(sized: DataFrame) -> DataFrame:
    """Per row of ``sized`` its source's words and target, the words the mix takes of it, and its first slot."""
    targets = materialize(source_targets(sized))
    planned = materialize(schedule(sized.sparkSession, targets, slot_count(targets)))
    taken = (
        blocks(sized, targets, planned)
        .join(planned, ["number", "rank"])
        .groupBy(ROW)
        .agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"))
    )
    known = targets.withColumnRenamed("source", "_source")
    return (
        sized.join(taken, ROW, "left")
        .join(known, F.col("source").eqNullSafe(F.col("_source")))
        .select(
            ROW, "key", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), "first_slot"
        )
    )


def mix_report(docs: DataFrame) -> DataFrame:
    mixed = mix(sized_rows(docs))
    return mixed.select(F.col("key").alias("doc_id"), "source", "size", "source_size", "target", "taken", "first_slot")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix, whole, as many times as it uses them.

    A document at the end of its source's last block, of which the mix needs a part, comes whole.
    """
    whole = located(docs)
    used = mix(sized_rows(whole, "row.text", "row.source", "row.doc_id", F.col(ROW))).filter("taken > 0")
    copies = F.ceil(F.col("taken") / F.col("size")).cast("int")
    repeated = attach(whole, used.select(ROW, copies.alias("copies")))
    return repeated.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
