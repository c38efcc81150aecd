from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.llm import nearest
from tallyforge.llm.nearest import Search

SCHEMA = "vec_id long, embedding array<float>, vector string, leaf string, part string, same_a string"


def frame(spark, rows):
    return spark.createDataFrame([(k, v, "x", "x", "x", "x") for k, v in rows], SCHEMA).repartition(5)


def brute(rows, every, most):
    """Per query row its nearest (id, score), ties to smaller ids, NULL ids last; a list, as ids may repeat."""
    usable = [(k, np.array(v, np.float32).astype(float)) for k, v in rows]
    found = []
    for place, (key, vector) in enumerate(usable):
        if key is None or key % every:
            continue
        scores = [(-float(v @ vector), k is None, k or 0) for n, (k, v) in enumerate(usable) if n != place]
        found.append((key, [(None if missing else k, -s) for s, missing, k in sorted(scores)[:most]]))
    return found


def clustered(count, seed=1, centers=12, width=10):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(centers, width)) * 3
    return [(k, (middles[k % centers] + rng.normal(size=width)).tolist()) for k in range(count)]


def by_query(result):
    found = defaultdict(list)
    for row in result.collect():
        found[row.query_id].append((row["rank"], row.vec_id, row.score))
    return {key: sorted(rows, key=lambda row: row[0]) for key, rows in found.items()}


def recall(got, expected):
    hits = total = 0
    for key, wanted in expected:
        hits += len({k for _, k, _ in got[key]} & {k for k, _ in wanted})
        total += len(wanted)
    return hits / total


@pytest.mark.parametrize("search", [Search(leaf_rows=40), Search(leaf_rows=20, sample=300, part_rows=100, query_rows=7)])
def test_recall_and_scores(spark, search):
    rows = clustered(2000)
    got = by_query(nearest.nearest(frame(spark, rows), F.col("key") % 20 == 0, search=search).withColumnRenamed("key", "vec_id"))
    expected = brute(rows, 20, 20)
    assert got.keys() == {key for key, _ in expected} and recall(got, expected) >= 0.9
    vectors = {k: np.array(v, np.float32).astype(float) for k, v in rows}
    for key, found in got.items():
        assert [place for place, _, _ in found] == list(range(1, 21)) and key not in {k for _, k, _ in found}
        assert [s for _, _, s in found] == sorted((s for _, _, s in found), reverse=True)
        assert all(score == pytest.approx(float(vectors[k] @ vectors[key])) for _, k, score in found)


def test_visiting_every_leaf_is_exact(spark):
    rows = [(k, np.random.default_rng(k).normal(size=6).tolist()) for k in range(600)]
    search = Search(leaf_rows=10, recall=1.0, trials=600, part_rows=64, query_rows=5)
    got = by_query(nearest.nearest(frame(spark, rows), F.col("key") % 20 == 0, search=search).withColumnRenamed("key", "vec_id"))
    for key, wanted in brute(rows, 20, 20):
        assert [k for _, k, _ in got[key]] == [k for k, _ in wanted]


def test_calibration_widens_until_the_recall_is_reached(spark):
    rows = [(k, np.random.default_rng(k).normal(size=16).tolist()) for k in range(1500)]
    seen = []
    for asked in (0.3, 0.7, 0.95):
        row = nearest.nearest(frame(spark, rows), F.col("key") % 5 == 0, search=Search(leaf_rows=30, recall=asked)).first()
        assert row.calibrated_recall >= asked and row.leaves > 20
        seen.append(row.visits)
    assert seen == sorted(seen) and seen[0] < seen[-1] <= row.leaves


def test_unusable_rows_take_no_part(spark):
    good = clustered(60, width=4)
    bad = [None, [], [0.0] * 4, [None] + [1.0] * 3, [math.nan] * 4, [math.inf] * 4, [9.0] * 3]
    rows = [*good, *((1000 + 20 * k, v) for k, v in enumerate(bad))]
    got = by_query(nearest.nearest_report(frame(spark, rows)))
    assert got.keys() == {0, 20, 40}
    assert all([k for _, k, _ in got[key]] == [k for k, _ in wanted] for key, wanted in brute(good, 20, 20))


def test_repeated_rows_ids_and_ties(spark):
    rows = [(20, [1.0, 0.0])] * 3 + [(7, [1.0, 0.0]), (None, [1.0, 0.0]), (40, [0.0, 1.0]), (-20, [2.0, 0.0])]
    result = nearest.nearest_report(frame(spark, rows)).collect()
    expected = brute(rows, 20, 20)
    assert sorted((r.query_id, r["rank"], repr(r.vec_id), r.score) for r in result) == sorted(
        (key, place, repr(k), s) for key, wanted in expected for place, (k, s) in enumerate(wanted, 1)
    )


def test_very_frequent_vectors(spark):
    """A third of all rows is one vector: only its smallest ids are searched, and every row is answered."""
    rows = [(k, [1.0, 2.0, 0.5]) if k % 3 else (k, np.random.default_rng(k).normal(size=3).tolist()) for k in range(1800)]
    search = Search(leaf_rows=25, copies=50, recall=1.0, trials=90, part_rows=128)
    df = frame(spark, rows)
    kept = nearest.without_surplus(nearest.usable_rows(df, "embedding", "vec_id")[0], 1800, search)
    assert kept.count() == 600 + 21
    got = by_query(nearest.nearest(df, F.col("key") % 20 == 0, search=search).withColumnRenamed("key", "vec_id"))
    expected = brute(rows, 20, 20)
    assert len(got) == 90
    for key, wanted in expected:
        assert [k for _, k, _ in got[key]] == [k for k, _ in wanted]


@pytest.mark.parametrize("rows", [[], [(20, None)], [(20, [1.0])], [(1, [1.0]), (3, [2.0])]])
def test_no_neighbours(spark, rows):
    assert nearest.nearest_report(frame(spark, rows)).isEmpty()


def test_tree_gives_every_leaf_once_best_first():
    vectors = np.random.default_rng(0).normal(size=(900, 5))
    tree = nearest.Tree()
    tree.add(vectors)
    tree.grow(0, vectors, Search(branching=4), 20, np.random.default_rng(1))
    tree = tree.sealed()
    order = tree.visits(vectors[0], tree.leaves)
    assert sorted(order) == list(range(tree.leaves)) and tree.visits(vectors[0], 5) == order[:5]
    leaves = tree.leaf_of(vectors)
    assert set(leaves) == set(range(tree.leaves))
    # A row's own leaf is among the first that a query with its vector visits.
    assert np.mean([leaves[k] in tree.visits(vectors[k], tree.leaves // 4) for k in range(200)]) > 0.9
