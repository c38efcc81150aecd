from __future__ import annotations

import random

import numpy as np
import pytest

import fixtures
from tallyforge.llm import neardup
from tallyforge.llm.words import WordHashes


@pytest.mark.parametrize("shingle", [2, 5])
def test_components_equal_brute_force(spark, shingle):
    rows = [row for row in fixtures.awkward_rows() if row[0] is not None]
    near = [(100 + k, fixtures.edited(fixtures.prose(50, 200), k, k % 9), None, None, None) for k in range(40)]
    docs = fixtures.awkward(spark, rows + near)
    expected = fixtures.near_components([row[:2] for row in rows + near], shingle, 80)
    got = neardup.near_duplicates(docs, shingle).collect()
    assert len(got) == len(rows + near)
    assert {row.id: row.component for row in got} == expected
    sizes = {key: len(fixtures.shingles(text, shingle)) for key, text, *_ in rows + near}
    assert {row.id: row.n_shingles for row in got} == sizes


def test_chain_through_documents_that_are_not_alike(spark):
    # Each is like the next one only; the smallest id ends up far from the last.
    words = fixtures.prose(3, 400, 10**6).split(" ")
    rows = [(k, " ".join(words[8 * k : 8 * k + 120]), None, None, None) for k in range(20)]
    random.Random(4).shuffle(rows)
    expected = fixtures.near_components([row[:2] for row in rows], 2, 80)
    got = neardup.near_duplicates(fixtures.awkward(spark, rows), 2).collect()
    assert set(expected.values()) == {0} and {row.id: row.component for row in got} == expected


def test_report_of_null_ids_and_empty_sets(spark):
    rows = [(None, "a b c", None, None, None), (2, None, None, None, None), (3, "", None, None, None), (4, "a b c", None, None, None)]
    got = neardup.near_duplicate_report(fixtures.awkward(spark, rows)).collect()
    assert {(row.doc_id, row.n_shingles, row.component_id, row.kept) for row in got} == {
        (None, 2, None, True),
        (2, 0, 2, True),
        (3, 0, 3, True),
        (4, 2, 4, True),
    }


def test_one_document_of_each_group_stays(spark):
    docs = fixtures.awkward(spark)
    kept = neardup.drop_near_duplicates(docs, 5)
    assert kept.columns == docs.columns
    rows = [row for row in fixtures.awkward_rows() if row[0] is not None]
    expected = set(fixtures.near_components([row[:2] for row in rows], 5, 80).values())
    ids = [row.doc_id for row in kept.collect()]
    assert sorted(k for k in ids if k is not None) == sorted(expected) and ids.count(None) == 2
    assert neardup.drop_near_duplicates(fixtures.awkward(spark, [])).collect() == []


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(7)
    for similarity in (0.0, 0.5, 0.8, 1.0):
        common, own = int(3000 * similarity), 3000 - int(3000 * similarity)
        draw = rng.integers(0, 2**63, common + 2 * own).astype(np.uint64) * np.uint64(2)
        a, b = np.unique(np.r_[draw[:common], draw[common : common + own]]), np.unique(np.r_[draw[:common], draw[common + own :]])
        estimate = neardup.estimate_jaccard(
            neardup.sketch(a)[None], neardup.sketch(b)[None], np.array([len(a)]), np.array([len(b)])
        )
        truth = common / (common + 2 * own)
        assert abs(estimate[0] - truth) < 0.13


def test_registers_hold_leading_zeros_and_mantissa():
    values = [0, 1, 5, 1 << 55, (1 << 56) - 1, (1 << 40) + 12345, 2**53 + 1]
    for value in values:
        register = int(neardup.sketch(np.array([value], np.uint64))[0])
        zeros, mantissa = register >> neardup.MANTISSA_BITS, register & 1023
        assert zeros == 56 - value.bit_length()
        bits = f"{value:b}"[1:] if value else ""
        assert mantissa == int((bits + "0" * 10)[:10], 2)


def test_components_of_a_long_path(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, 101), (101, 100)]
    got = neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {row.node: row.component for row in got} == {**{k: 0 for k in range(61)}, 100: 100, 101: 100}


def test_shingle_hashes_agree_with_sets():
    texts = [text for _, text, *_ in fixtures.awkward_rows()]
    for size in (2, 5):
        assert [len(neardup.shingle_hashes(text, size, WordHashes())) for text in texts] == [
            len(fixtures.shingles(text, size)) for text in texts
        ]
