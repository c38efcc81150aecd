"""Near-duplicate groups with HyperMinHash sketches and verified links.

A document's set is its word shingles, lower-cased. One 64-bit hash per shingle picks a bucket
and leaves the rest for its register: the leading-zero count of the bucket's smallest hash and
its next ten bits, sixteen bits in all. Bands of registers that agree make candidates; the
Jaccard estimate over all registers, less the agreements that chance gives, thins them out; the
rest are verified on the full sets.

Documents with equal sets are one class from the start. Candidates are tested in two rounds. First
every class of a band bucket is paired with one hub, the class that shares buckets with most
others, as the original of many copies does. Then the classes that are still in a bucket with
another component are paired exactly, by the rarest shingles of which similar sets must share one
early enough. A pair within one component needs no test, so no group is expanded into all its
pairs and no link is lost that changes a component.

Rows with an empty set or without an id are linked with nothing; they stand alone (a NULL id
has a NULL component and is kept). Rows that share an id are judged each by its own text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField

from tallyforge.llm.hashing import scramble
from tallyforge.llm.rows import bounded
from tallyforge.llm.words import WordHashes, find_words, lower_ascii, map_column
from tallyforge.sources.storage import materialize

#: Two registers that differ agree with probability below 1/1000, so 42 bands of 6 of the 256
#: registers miss a pair of similarity 0.8 with probability (1 - 0.8 ** 6) ** 42 < 4e-6.
BUCKET_BITS, BAND_ROWS = 8, 6
BUCKETS = 1 << BUCKET_BITS
BANDS = BUCKETS // BAND_ROWS
MANTISSA_BITS = 10
_EMPTY = 0xFFFF
_REST_BITS = 64 - BUCKET_BITS
#: The estimate's standard error at similarity 0.8 is 0.025; pairs five of them below are dropped.
MARGIN = 0.125


def shingle_hashes(text: str | None, shingle: int, codes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    words = find_words(lower_ascii(text)) if text else []
    if not words:
        return np.empty(0, np.uint64)
    values = codes.of(words)
    size = min(shingle, len(words))
    count = len(words) - size + 1
    mixed = np.full(count, np.uint64(size))
    for step in range(size):
        mixed = scramble(mixed ^ values[step : step + count])
    return np.unique(mixed)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """One register per bucket: leading zeros of the smallest hash, then its mantissa bits."""
    registers = np.full(BUCKETS, _EMPTY, np.uint16)
    if not len(hashes):
        return registers
    bucket = (hashes >> np.uint64(_REST_BITS)).astype(np.int64)
    rest = hashes & np.uint64((1 << _REST_BITS) - 1)
    # ``hashes`` is sorted: the first of each bucket is its smallest.
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    smallest = rest[first]
    length = np.frexp(smallest.astype(np.float64))[1].astype(np.int64)
    # Rounding to a double may carry into the next power of two.
    length -= (smallest >> np.maximum(length - 1, 0).astype(np.uint64)) == 0
    length = np.maximum(length, 0)
    zeros = _REST_BITS - length
    shift = length - 1 - MANTISSA_BITS
    below = np.where(shift >= 0, smallest >> np.maximum(shift, 0).astype(np.uint64), smallest << np.maximum(-shift, 0).astype(np.uint64))
    mantissa = below & np.uint64((1 << MANTISSA_BITS) - 1)
    registers[bucket[first]] = (zeros.astype(np.uint16) << MANTISSA_BITS) | mantissa.astype(np.uint16)
    return registers


def expected_collisions(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Registers of two unrelated sets that agree by chance (HyperMinHash paper, approximation)."""
    ratio = np.maximum(n, m) / np.maximum(np.minimum(n, m), 1)
    return 0.169919487159739 * 2.0 ** (BUCKET_BITS - MANTISSA_BITS) * 4 * ratio / (1 + ratio) ** 2


def estimate_jaccard(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Collision-corrected similarity of sketches, one pair per row."""
    filled = ((a != _EMPTY) | (b != _EMPTY)).sum(axis=1)
    agree = ((a == b) & (a != _EMPTY)).sum(axis=1)
    # Sets much smaller than the sketch leave most registers empty and rarely collide.
    chance = np.minimum(expected_collisions(n, m) * filled / BUCKETS, agree)
    return (agree - chance) / np.maximum(filled, 1)


def signatures(docs: DataFrame, shingle: int) -> DataFrame:
    """``id`` and ``text`` to ``id``, set size, digest of the set, and sketch."""
    fields = [
        StructField("n_shingles", LongType()),
        StructField("set_key", BinaryType()),
        StructField("sketch", BinaryType()),
    ]

    def sign(texts: list) -> list[list]:
        sizes, keys, sketches = [], [], []
        codes = WordHashes()
        for text in texts:
            hashes = shingle_hashes(text, shingle, codes)
            sizes.append(len(hashes))
            keys.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None)
            sketches.append(sketch(hashes).tobytes() if len(hashes) else None)
        return [sizes, keys, sketches]

    return map_column(docs, "text", fields, sign)


def _bands(classes: DataFrame) -> DataFrame:
    """``band`` hash and ``node`` for every band with a filled register."""
    width = 2 * BAND_ROWS
    numbers = F.sequence(F.lit(0), F.lit(BANDS - 1))
    pieces = F.transform(numbers, lambda k: F.substring(F.col("sketch"), k * width + 1, F.lit(width)))
    exploded = classes.select("node", "n_shingles", F.posexplode(pieces).alias("k", "piece"))
    return exploded.filter(F.col("piece") != F.lit(b"\xff" * width)).select(
        F.xxhash64("k", "piece").alias("band"), "node", F.col("n_shingles").alias("n")
    )


def _near_size(n: str, m: str, percent: int) -> Column:
    """Set sizes that allow the similarity at all."""
    return (100 * F.least(n, m)) >= percent * F.greatest(n, m)


def _promising(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose estimated similarity is not far below the threshold."""
    known = classes.select("node", "n_shingles", "sketch")
    both = pairs.join(known.toDF("a", "n", "sketch_a"), "a").join(known.toDF("b", "m", "sketch_b"), "b")
    least = percent / 100 - MARGIN

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sketches = [_stack(batch.column(name)) for name in ("sketch_a", "sketch_b")]
            sizes = [batch.column(name).to_numpy(zero_copy_only=False) for name in ("n", "m")]
            keep = pa.array(estimate_jaccard(*sketches, *sizes) >= least)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])

    return both.filter(_near_size("n", "m", percent)).mapInArrow(thin, pairs.select("a", "b").schema)


def _stack(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, BUCKETS)


def _texts_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id is listed in ``nodes``, a written table of distinct ids."""
    return docs.join(bounded(nodes.withColumnRenamed("node", "id")), "id", "left_semi")


def _sets_of(docs: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """``node`` and full ``set`` of the listed ids, written out."""

    def sets(texts: list) -> list[list]:
        codes = WordHashes()
        return [[shingle_hashes(text, shingle, codes).view(np.int64) for text in texts]]

    fields = [StructField("set", ArrayType(LongType()))]
    return materialize(map_column(_texts_of(docs, nodes), "text", fields, sets).withColumnRenamed("id", "node"))


def _verified(pairs: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough; ``pairs`` is a written table."""
    nodes = materialize(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    full = _sets_of(docs, nodes, shingle)
    met = pairs.join(full.toDF("a", "set_a"), "a").join(full.toDF("b", "set_b"), "b")
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - F.col("common")
    return met.select("a", "b", "set_a", "set_b", common.alias("common")).filter(
        100 * F.col("common") >= percent * union
    ).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) of every node on an edge.

    Alternates two star steps until the edges are stars. Each replaces edges by edges to smaller
    nodes and is a minimum per node followed by a join, so a node with very many neighbours is
    combined before the shuffle and never gathered.
    """
    links = edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("hi <> lo").distinct()
    while True:
        links = materialize(_small_star(_large_star(links)))
        repeated = links.groupBy("hi").count().filter("count > 1").select("hi")
        chained = links.select(F.col("lo").alias("hi")).distinct().join(links, "hi", "left_semi")
        if repeated.unionByName(chained).isEmpty():
            break
    own = links.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(own)


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node around."""
    both = links.unionByName(links.select(F.col("lo").alias("hi"), F.col("hi").alias("lo"))).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
    return linked.distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    least = links.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = links.join(least, "hi").filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()


def _crowded(classes: DataFrame) -> DataFrame:
    """Band rows of buckets with several classes; ``shared`` sums a class's bucket sizes."""
    bands = _bands(classes)
    sizes = bands.groupBy("band").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    own = Window.partitionBy("node")  # at most BANDS rows
    return bands.join(sizes, "band").select("band", "node", "n", F.sum("members").over(own).alias("shared"))


def _marked(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` with the component of each ``node`` so far, ``part``."""
    joined = rows.join(bounded(found), "node", "left")
    return joined.withColumn("part", F.coalesce("component", "node")).drop("component")


def _hub_pairs(crowded: DataFrame, percent: int) -> DataFrame:
    """Members with their bucket's hub."""
    hubs = crowded.groupBy("band").agg(F.max(F.struct("shared", "node", "n")).alias("hub"))
    hubs = hubs.select("band", F.col("hub.node").alias("b"), F.col("hub.n").alias("m"))
    met = crowded.select("band", F.col("node").alias("a"), "n").join(hubs, "band")
    return _distinct_pairs(met.filter(_near_size("n", "m", percent)))


def _open_classes(marked: DataFrame) -> DataFrame:
    """Classes that share a bucket with one of another component."""
    mixed = marked.groupBy("band").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low <> high")
    return marked.join(mixed.select("band"), "band", "left_semi").select("node").distinct()


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """The rarest shingles of each set, so many that similar sets have one of them in common.

    A set of n shingles shares at least ``percent`` of them with a similar one, so with shingles
    in one order for all sets, the first n - ceil(percent * n) + 1 of both meet. The order is by
    the number of sets that have a shingle; those that one set alone has come first and are not
    listed, so a set with enough of its own drops out. ``place`` counts from 1 in that order.
    """
    rows = sets.select("node", F.monotonically_increasing_id().alias("set_row"), F.size("set").alias("n"), "set")
    shingles = materialize(rows).select("node", "set_row", "n", F.explode("set").alias("shingle"))
    common = shingles.groupBy("shingle").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    own = Window.partitionBy("set_row")
    ranked = shingles.join(common, "shingle").select(
        "node",
        "n",
        "shingle",
        (F.row_number().over(own.orderBy("times", "shingle")) + F.col("n") - F.count(F.lit(1)).over(own)).alias("place"),
    )
    return ranked.filter(F.col("place") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)


def _remaining_pairs(crowded: DataFrame, found: DataFrame, named: DataFrame, shingle: int, percent: int) -> DataFrame:
    """All pairs of open classes in different components that can be similar, by prefix.

    Where the first shingle that two sets share comes late in either, too few are left for the
    overlap that the similarity takes. The sets with a shingle that are outside its largest component are paired with all its sets,
    so one large component and a few others give few pairs.
    """
    nodes = materialize(_open_classes(_marked(crowded, found)))
    rows = materialize(_marked(_prefixes(_sets_of(named, nodes, shingle), percent), found))
    rows = rows.select("shingle", "node", "n", "place", "part")
    parts = rows.groupBy("shingle", "part").agg(F.count(F.lit(1)).alias("members"))
    largest = parts.groupBy("shingle").agg(F.max(F.struct("members", "part")).alias("top"), F.count(F.lit(1)).alias("parts"))
    largest = largest.filter("parts > 1").select("shingle", F.col("top.part").alias("main"))
    right = rows.join(largest, "shingle").select("shingle", "node", "n", "place", "part", "main")
    left = right.filter("part <> main").toDF("shingle", "a", "n", "place_a", "part_a", "main")
    right = right.drop("main").toDF("shingle", "b", "m", "place_b", "part_b")
    apart = (F.col("part_a") != F.col("part_b")) & ((F.col("part_b") == F.col("main")) | (F.col("a") > F.col("b")))
    most = 1 + F.least(F.col("n") - F.col("place_a"), F.col("m") - F.col("place_b"))
    enough = most * (100 + percent) >= percent * (F.col("n") + F.col("m"))
    return _distinct_pairs(left.join(right, "shingle").filter(apart & enough & _near_size("n", "m", percent)))


def _distinct_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()


def near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row its ``id``, set size and component under links of at least ``percent`` similarity."""
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    named = rows.filter("id IS NOT NULL")
    signed = materialize(signatures(rows, shingle))
    classes = materialize(
        signed.filter("set_key IS NOT NULL AND id IS NOT NULL")
        .groupBy("set_key")
        .agg(F.min("id").alias("node"), *(F.first(name).alias(name) for name in ("n_shingles", "sketch")))
    )
    crowded = materialize(_crowded(classes))
    starred = materialize(_hub_pairs(crowded, percent))
    links = materialize(_verified(materialize(_promising(starred, classes, percent)), named, shingle, percent))
    found = materialize(components(links))
    apart = _remaining_pairs(crowded, found, named, shingle, percent).join(starred, ["a", "b"], "left_anti")
    apart = materialize(_promising(apart, classes, percent))
    if not apart.isEmpty():
        found = components(links.unionByName(_verified(apart, named, shingle, percent)))
    # Classes that share their smallest id are one node.
    by_class = classes.join(found, "node", "left").select("set_key", F.coalesce("component", "node").alias("component"))
    return (
        signed.join(by_class, "set_key", "left")
        .select("id", "n_shingles", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"))
    )


def near_duplicate_report(docs: DataFrame, shingle: int = 2, percent: int = 80) -> DataFrame:
    found = near_duplicates(docs, shingle, percent)
    return found.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, with its columns as they are; of rows that share an id, one.

    Rows without an id are all kept.
    """
    found = near_duplicates(docs, shingle, percent)
    kept = found.filter(F.col("id") == F.col("component")).select(F.col("id").alias("kept_id")).distinct()
    staged = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("kept_id"))
    named = staged.filter("kept_id IS NOT NULL").join(kept, "kept_id", "left_semi").dropDuplicates(["kept_id"])
    return named.unionByName(staged.filter("kept_id IS NULL")).select("row.*")
