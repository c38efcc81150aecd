"""Approximate nearest neighbours by inner product, with a hierarchical k-means tree.

The tree is fitted on a bounded sample (``Search.sample``): k-means splits the sample into
``branching`` parts, each part again, until a part stands for about ``leaf_rows`` rows of the table. Every
row descends to the leaf of the nearest centres. A query goes through the tree best bin first: a priority
queue holds the nodes seen and gives out the one whose rows can be expected to score highest, until
enough leaves are visited. How many are enough is calibrated: ``trials`` queries are compared with all
rows, and the visits widen until their recall reaches ``recall``; visiting all leaves is exact.

Leaves that lie together in the tree make a part of about ``part_rows`` rows. Queries go to the parts
that hold a leaf they visit, and a task compares one block of a part's rows with one block of its queries,
so no leaf, however popular, makes a task larger. Queries with equal vectors are searched once. Of a
vector with very many copies only the rows with the smallest ids are searched, one more than the
neighbours asked for: equal scores go to smaller ids, so the others cannot be among the nearest. Equal vectors are
told by 128 bits of hash.

Vectors that are NULL, zero, hold a NULL or an entry that is not finite, or are not of the commonest length take no
part. A NULL id is no query; as a candidate it comes after all others among equal scores. A row is
its own query's neighbour never, another row of the same id may be.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from tallyforge.llm.rows import ROW, scan_row
from tallyforge.llm.vectors import common_length, finite_rows
from tallyforge.sources.storage import materialize

SAME = ("same_a", "same_b")
NO_ID = np.iinfo(np.int64).max
#: Numbers in one product of query and row vectors.
PRODUCT = 1 << 22


@dataclass(frozen=True)
class Search:
    """Neighbours per query, and how to find them."""

    neighbours: int = 20
    recall: float = 0.95
    trials: int = 256
    branching: int = 16
    leaf_rows: int = 256
    #: Vectors that the tree is fitted on, and the fewest of them in a leaf that is split off.
    sample: int = 1 << 17
    least_sample: int = 8
    part_rows: int = 1 << 14
    query_rows: int = 1 << 13
    #: Copies of one vector from which on only the smallest ids are searched, at least.
    copies: int = 1 << 12


@dataclass
class Tree:
    """Nodes in arrays; the children of a node follow one another. Leaves are numbered in tree order."""

    centers: list = field(default_factory=list)
    #: Root mean square distance of a node's vectors from its centre, per entry.
    spread: list = field(default_factory=list)
    first: list = field(default_factory=list)
    last: list = field(default_factory=list)
    leaf: list = field(default_factory=list)
    leaves: int = 0

    def add(self, vectors: np.ndarray) -> int:
        center = vectors.mean(axis=0)
        self.centers.append(center)
        self.spread.append(float(np.sqrt(np.square(vectors - center).mean())))
        self.first.append(0)
        self.last.append(0)
        self.leaf.append(-1)
        return len(self.leaf) - 1

    def grow(self, node: int, vectors: np.ndarray, search: Search, leaf_sample: float, rng) -> None:
        # Fewer parts near the leaves, so that leaves are about as large as asked for.
        count = min(search.branching, math.ceil(len(vectors) / leaf_sample))
        parts = k_means(vectors, count, rng) if count > 1 else None
        if parts is None or parts.max() == 0:
            self.leaf[node], self.leaves = self.leaves, self.leaves + 1
            return
        members = [vectors[parts == part] for part in range(parts.max() + 1)]
        nodes = [self.add(found) for found in members]
        self.first[node], self.last[node] = nodes[0], nodes[-1] + 1
        for child, found in zip(nodes, members):
            self.grow(child, found, search, leaf_sample, rng)

    def sealed(self) -> Tree:
        arrays = (np.array(each) for each in (self.centers, self.spread, self.first, self.last, self.leaf))
        return Tree(*arrays, self.leaves)

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector: at every node the nearest child."""
        nodes = np.zeros(len(vectors), np.int64)
        open_ = np.arange(len(vectors)) if self.leaf[0] < 0 else np.zeros(0, np.int64)
        half = np.square(self.centers).sum(axis=1) / 2
        while len(open_):
            for node in np.unique(nodes[open_]).tolist():
                rows = open_[nodes[open_] == node]
                children = slice(self.first[node], self.last[node])
                nearest = (vectors[rows] @ self.centers[children].T - half[children]).argmax(axis=1)
                nodes[rows] = self.first[node] + nearest
            open_ = open_[self.leaf[nodes[open_]] < 0]
        return self.leaf[nodes]

    def visits(self, query: np.ndarray, count: int) -> list[int]:
        """The first ``count`` leaves, best bin first.

        A node counts as good as a row two deviations above its centre.
        """
        reach = 2 * float(np.linalg.norm(query))
        heap, found = [(0.0, 0)], []
        while heap and len(found) < count:
            _, node = heapq.heappop(heap)
            if self.leaf[node] >= 0:
                found.append(int(self.leaf[node]))
                continue
            first, last = int(self.first[node]), int(self.last[node])
            hopes = self.centers[first:last] @ query + reach * self.spread[first:last]
            for child, hope in zip(range(first, last), hopes.tolist()):
                heapq.heappush(heap, (-hope, child))
        return found


def k_means(vectors: np.ndarray, count: int, rng, rounds: int = 8) -> np.ndarray:
    """A part number per vector; parts are numbered without gaps."""
    centers = vectors[rng.choice(len(vectors), min(count, len(vectors)), replace=False)]
    for _ in range(rounds):
        parts = (vectors @ centers.T - np.square(centers).sum(axis=1) / 2).argmax(axis=1)
        used, parts = np.unique(parts, return_inverse=True)
        sums = np.zeros((len(used), vectors.shape[1]))
        np.add.at(sums, parts, vectors)
        centers = sums / np.bincount(parts)[:, None]
    return parts


def usable_rows(df: DataFrame, vector: str, key: str) -> tuple[DataFrame, int]:
    """Rows that take part, written out: position, id, vector and its hashes; and the vectors' length."""
    length = common_length(df, vector)
    narrow = df.select(scan_row().alias(ROW), F.col(key).cast("long").alias("key"), F.col(vector).alias("vector"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, values = finite_rows(batch.column("vector"), length)
            yield batch.take(pa.array(places[values.any(axis=1)]))

    hashes = [F.xxhash64(F.lit(seed), "vector").alias(name) for seed, name in enumerate(SAME, 1)]
    return materialize(narrow.mapInArrow(run, narrow.schema).select("*", *hashes)), length


def matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, max(1, length))


def fit_tree(rows: DataFrame, count: int, length: int, search: Search) -> Tree:
    """The tree over a sample of distinct vectors, about ``search.sample`` of them, drawn by their hash."""
    share = min(1.0, search.sample / max(1, count))
    # Half of the range of hashes is negative.
    drawn = F.shiftrightunsigned(SAME[0], 11) < int(share * (1 << 53))
    picked = rows.filter(drawn).dropDuplicates(list(SAME)).orderBy(*SAME).limit(search.sample).select("vector").toArrow()
    vectors = matrix(picked.column(0).combine_chunks(), length)
    tree, rng = Tree(), np.random.default_rng(length)
    if len(vectors) == 0:
        vectors = np.zeros((1, max(1, length)))
    tree.add(vectors)
    leaf_sample = max(search.least_sample, search.leaf_rows * len(vectors) / max(1, count))
    tree.grow(0, vectors, search, leaf_sample, rng)
    return tree.sealed()


def with_leaves(rows: DataFrame, tree: Tree, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = tree.leaf_of(matrix(batch.column("vector"), length))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=[*batch.schema.names, "leaf"])

    return rows.mapInArrow(run, StructType([*rows.schema, StructField("leaf", LongType())]))


def without_surplus(rows: DataFrame, count: int, search: Search) -> DataFrame:
    """``rows`` less copies of very frequent vectors that cannot be among the nearest of any query.

    A vector counts as frequent from max(``copies``, rows / 2**18) copies on, so there are at most
    2**18 of them, whatever the table.
    """
    least = max(search.copies, count >> 18)
    frequent = rows.groupBy(*SAME).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > least)
    frequent = materialize(frequent.select(*SAME))
    if frequent.isEmpty():
        return rows
    frequent = F.broadcast(frequent)
    order = Window.partitionBy(*SAME).orderBy(F.asc_nulls_last("key"), ROW)
    copies = rows.join(frequent, list(SAME)).select(*SAME, "key", ROW).withColumn("place", F.row_number().over(order))
    # Limited within each task before the shuffle.
    first = materialize(copies.filter(F.col("place") <= search.neighbours + 1).select(ROW))
    others = rows.join(frequent, list(SAME), "left_anti")
    return others.unionByName(rows.join(frequent, list(SAME), "left_semi").join(F.broadcast(first), ROW, "left_semi"))


class Best:
    """The highest scores per query among the rows shown, ties to smaller ids, then positions."""

    def __init__(self, queries: int, most: int) -> None:
        self.most, self.least = most, np.full(queries, -np.inf)
        self.parts: list[tuple] = []
        self.held = 0

    def show(self, which: np.ndarray, scores: np.ndarray, first_row: int) -> None:
        """Scores of the queries ``which`` (rows) against the rows from ``first_row`` on (columns)."""
        if scores.shape[1] >= self.most:
            place = scores.shape[1] - self.most
            self.least[which] = np.maximum(self.least[which], np.partition(scores, place, axis=1)[:, place])
        q, r = np.nonzero(scores >= self.least[which][:, None])
        self.parts.append((which[q], scores[q, r], r + first_row))
        self.held += len(q)

    def settle(self, keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, score and row number of what remains; only this is kept."""
        if not self.parts:
            empty = np.zeros(0, np.int64)
            return empty, np.zeros(0), empty
        q, score, r = (np.concatenate(each) for each in zip(*self.parts))
        order = np.lexsort((rows[r], keys[r], -score, q))
        q, score, r = q[order], score[order], r[order]
        starts = np.flatnonzero(np.diff(q, prepend=-1))
        place = np.arange(len(q)) - np.repeat(starts, np.diff(np.append(starts, len(q))))
        near = place < self.most
        self.parts, self.held = [(q[near], score[near], r[near])], int(near.sum())
        last = place == self.most - 1
        self.least[q[last]] = np.maximum(self.least[q[last]], score[last])
        return self.parts[0]


def ids(column) -> np.ndarray:
    return np.asarray(column.fill_null(NO_ID).combine_chunks() if isinstance(column, pa.ChunkedArray) else column.fill_null(NO_ID))


def calibrated_visits(indexed: DataFrame, trials: pa.Table, tree: Tree, length: int, search: Search) -> tuple[int, float]:
    """Leaves a query has to visit, and the recall of ``trials`` (position, vector) that they give.

    The trials are compared with all rows. A true neighbour is found if its leaf is among those
    visited, so its place in the order of visits tells from which width on it is.
    """
    if len(trials) == 0 or tree.leaves == 1:
        return tree.leaves, 1.0
    queries = matrix(trials.column("vector").combine_chunks(), length)
    own, most = np.asarray(trials.column(ROW)), search.neighbours + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            # What was best so far goes on as rows in front of the batch.
            found = Best(len(queries), most)
            vectors = matrix(batch.column("vector"), length)
            rows, keys = np.asarray(batch.column(ROW)), ids(batch.column("key"))
            leaves = np.asarray(batch.column("leaf"))
            step = max(1, PRODUCT // len(queries))
            for start in range(0, len(vectors), step):
                found.show(np.arange(len(queries)), queries @ vectors[start : start + step].T, start)
            q, score, r = found.settle(keys, rows)
            new = (q, score, keys[r], rows[r], leaves[r])
            merged = new if kept is None else tuple(np.concatenate(pair) for pair in zip(kept, new))
            order = np.lexsort((merged[3], merged[2], -merged[1], merged[0]))
            merged = tuple(each[order] for each in merged)
            starts = np.flatnonzero(np.diff(merged[0], prepend=-1))
            place = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
            kept = tuple(each[place < most] for each in merged)
        if kept is not None:
            yield pa.RecordBatch.from_arrays([pa.array(each) for each in kept], names=["q", "score", "key", ROW, "leaf"])

    near = indexed.mapInArrow(run, f"q long, score double, key long, {ROW} long, leaf long")
    near = near.withColumn("place", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "key", ROW)))
    truth: list[list[int]] = [[] for _ in range(len(queries))]
    for row in near.filter(F.col("place") <= most).orderBy("q", "place").collect():
        if row[ROW] != own[row["q"]] and len(truth[row["q"]]) < search.neighbours:
            truth[row["q"]].append(row["leaf"])
    needed = []
    for query, leaves in zip(queries, truth):
        place = {leaf: number for number, leaf in enumerate(tree.visits(query, tree.leaves), 1)}
        needed += [place[leaf] for leaf in leaves]
    width = 1
    while True:
        reached = float(np.mean(np.array(needed) <= width)) if needed else 1.0
        if reached >= search.recall or width == tree.leaves:
            return width, reached
        width = min(tree.leaves, width + max(1, width // 8))


def tiles(indexed: DataFrame, routed: DataFrame, parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows and queries by part and block: every row block of a part meets every query block of it."""
    salt = lambda of, blocks: F.pmod(F.xxhash64(of), F.col(blocks))
    every = lambda blocks: F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1))
    rows = indexed.join(F.broadcast(parts.select("leaf", "part", "row_blocks", "query_blocks")), "leaf")
    rows = rows.withColumn("row_block", salt(ROW, "row_blocks")).withColumn("query_block", every("query_blocks"))
    asked = parts.select("part", "row_blocks", "query_blocks").distinct()
    queries = routed.join(F.broadcast(asked), "part")
    queries = queries.withColumn("query_block", salt(SAME[0], "query_blocks")).withColumn("row_block", every("row_blocks"))
    tile = ["part", "row_block", "query_block"]
    return rows.select(*tile, "leaf", "key", ROW, "vector"), queries.select(*tile, *SAME, "leaves", "vector")


def route(queries: DataFrame, tree: Tree, length: int, visits: int, part_of: np.ndarray) -> DataFrame:
    """Per query and part that it visits: the leaves it visits there."""
    schema = StructType([*queries.schema]).add("part", LongType()).add("leaves", ArrayType(LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, parts, lists = [], [], []
            for place, query in enumerate(matrix(batch.column("vector"), length)):
                by_part: dict[int, list[int]] = {}
                for leaf in tree.visits(query, visits):
                    by_part.setdefault(int(part_of[leaf]), []).append(leaf)
                for part, leaves in by_part.items():
                    places.append(place)
                    parts.append(part)
                    lists.append(leaves)
            arrays = batch.take(pa.array(places, pa.int64())).columns
            arrays += [pa.array(parts, pa.int64()), pa.array(lists, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return queries.mapInArrow(run, schema)


def search_tile(rows: pa.Table, queries: pa.Table, length: int, most: int) -> pa.Table:
    """The nearest rows of one block for each query of one block, over the leaves that it visits."""
    names = [*SAME, "score", "key", ROW]
    if len(rows) == 0 or len(queries) == 0:
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
        return pa.table([pa.array([], kind) for kind in kinds], names=names)
    rows = rows.sort_by("leaf")
    leaves, keys, numbers = np.asarray(rows.column("leaf")), ids(rows.column("key")), np.asarray(rows.column(ROW))
    vectors = matrix(rows.column("vector").combine_chunks(), length)
    asked = matrix(queries.column("vector").combine_chunks(), length)
    lists = queries.column("leaves").combine_chunks()
    wanted = np.asarray(lists.flatten())
    owners = np.repeat(np.arange(len(asked)), np.diff(np.asarray(lists.offsets)))
    order = np.argsort(wanted, kind="stable")
    wanted, owners = wanted[order], owners[order]
    best = Best(len(asked), most)
    for leaf in np.unique(leaves).tolist():
        which = owners[slice(*np.searchsorted(wanted, [leaf, leaf + 1]))]
        first, last = np.searchsorted(leaves, [leaf, leaf + 1]).tolist()
        step = max(1, PRODUCT // max(1, last - first))
        for start in range(0, len(which), step):
            some = which[start : start + step]
            best.show(some, asked[some] @ vectors[first:last].T, first)
        if best.held > PRODUCT:
            best.settle(keys, numbers)
    q, score, r = best.settle(keys, numbers)
    found = [queries.column(name).take(pa.array(q)) for name in SAME]
    return pa.table([*found, pa.array(score), rows.column("key").take(pa.array(r)), pa.array(numbers[r])], names=names)


def nearest(
    df: DataFrame, is_query: Column, vector: str = "embedding", key: str = "vec_id", search: Search = Search()
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``key`` and ``score`` of the neighbours found of every query row.

    ``is_query`` is a condition on ``key``. Further columns: the visits and the recall they had on trials.
    """
    spark = df.sparkSession
    rows, length = usable_rows(df, vector, key)
    count = rows.count()
    tree = fit_tree(rows, count, length, search)
    indexed = with_leaves(without_surplus(rows, count, search), tree, length)
    asking = rows.filter(F.coalesce(is_query, F.lit(False)))
    classes = asking.groupBy(*SAME).agg(F.any_value("vector").alias("vector"), F.count(F.lit(1)).alias("copies"))
    trials = asking.orderBy(F.xxhash64(ROW), ROW).limit(search.trials).select(ROW, "vector").toArrow()
    visits, reached = calibrated_visits(indexed, trials, tree, length, search)

    # One number per leaf of the tree, which is as large as the sample allows.
    held = np.zeros(tree.leaves, np.int64)
    for row in indexed.groupBy("leaf").count().collect():
        held[row["leaf"]] = row["count"]
    part_of = (np.cumsum(held) - held) // search.part_rows
    routed = materialize(route(classes.select(*SAME, "vector"), tree, length, visits, part_of))
    waiting = {row["part"]: row["count"] for row in routed.groupBy("part").count().collect()}
    in_part = np.bincount(part_of, held)
    table = [
        (leaf, int(part), math.ceil(in_part[part] / search.part_rows), math.ceil(waiting[part] / search.query_rows))
        for leaf, part in enumerate(part_of.tolist())
        if part in waiting and held[leaf]
    ]
    table = [(leaf, part, max(1, int(a)), max(1, int(b))) for leaf, part, a, b in table]
    parts = spark.createDataFrame(table, "leaf long, part long, row_blocks long, query_blocks long")
    left, right = tiles(indexed, routed, parts)
    most, tile = search.neighbours + 1, ["part", "row_block", "query_block"]
    found = (
        left.groupBy(*tile)
        .cogroup(right.groupBy(*tile))
        .applyInArrow(lambda a, b: search_tile(a, b, length, most), f"same_a long, same_b long, score double, key long, {ROW} long")
    )
    order = Window.partitionBy(*SAME).orderBy(F.desc("score"), F.asc_nulls_last("key"), ROW)
    near = found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)
    lists = near.groupBy(*SAME).agg(F.array_sort(F.collect_list(F.struct("place", "score", "key", ROW))).alias("near"))
    lists = materialize(lists)

    # Query rows of one vector are dealt over as many copies of its list as they fill blocks.
    total = max(1, asking.count())
    least = max(search.copies, total >> 18)
    crowded = classes.filter(F.col("copies") > least).select(*SAME, F.ceil(F.col("copies") / least).alias("blocks"))
    crowded = F.broadcast(materialize(crowded))
    blocks = F.coalesce("blocks", F.lit(1).cast("long"))
    queries = asking.select(ROW, F.col("key").alias("query_id"), *SAME).join(crowded, list(SAME), "left")
    queries = queries.withColumn("block", F.pmod(F.xxhash64(ROW), blocks)).withColumnRenamed(ROW, "own").drop("blocks")
    dealt = lists.join(crowded, list(SAME), "left")
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))).drop("blocks")
    others = F.slice(F.filter("near", lambda each: each[ROW] != F.col("own")), 1, search.neighbours)
    matched = queries.join(dealt, [*SAME, "block"]).select("query_id", F.posexplode(others).alias("place", "one"))
    return matched.select(
        "query_id",
        (F.col("place") + 1).alias("rank"),
        F.col("one.key").alias("key"),
        F.col("one.score").alias("score"),
        F.lit(visits).alias("visits"),
        F.lit(tree.leaves).alias("leaves"),
        F.lit(reached).alias("calibrated_recall"),
    )


def nearest_report(df: DataFrame, vector: str = "embedding", key: str = "vec_id", every: int = 20) -> DataFrame:
    found = nearest(df, F.pmod(F.col("key"), F.lit(every)) == 0, vector, key)
    return found.withColumnRenamed("key", "vec_id")
