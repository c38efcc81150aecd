from __future__ import annotations

import random

import pytest

import fixtures
from tallyforge.llm import decontaminate


def benchmark_rows():
    return [
        (1, fixtures.prose(900, 30)),
        (20, fixtures.prose(901, 13)),
        (3, "only four words here"),
        (4, None),
        (5, " .,; "),
        (None, fixtures.prose(902, 20)),
        (1, fixtures.prose(903, 15)),
        (7, "word"),
    ]


def document_rows():
    bench = [text for _, text in benchmark_rows()]
    rows = fixtures.awkward_rows()
    base = fixtures.prose(10, 60)
    extra = [
        base + ", " + bench[0].upper() + "! " + base,
        base + " " + " ".join(bench[0].split()[5:18]) + " " + base * 20,
        bench[1],
        "x only; FOUR words-here y",
        base + " " + bench[5] + " " + bench[6],
        "a word in between",
        bench[0] + " " + bench[0],
    ]
    return rows + [(200 + k, text, None, None, None) for k, text in enumerate(extra)]


@pytest.mark.parametrize("block_bytes", [1 << 20, 100])
def test_hits_equal_brute_force(spark, block_bytes):
    rows, bench = document_rows(), benchmark_rows()
    benchmark = spark.createDataFrame([(*row, "x") for row in bench], "item_id long, text string, hits string")
    docs = fixtures.awkward(spark, rows).select("doc_id", "text")
    found = decontaminate.find_contamination(docs, benchmark, block_bytes=block_bytes).collect()
    got = sorted(
        (
            (r.doc_id, r.text, r.hits.n_words, sum(s.end - s.start for s in r.hits.spans), {i for i in r.hits["items"] if i})
            for r in found
        ),
        key=repr,
    )
    expected = []
    for key, text, *_ in rows:
        n_words, n_hit, *_ = fixtures.contamination(text, bench)
        items = {str(item) for item, own in bench if item is not None and fixtures.contamination(text, [(item, own)])[1]}
        expected.append((key, text, n_words, n_hit, items))
    assert [row[:4] for row in got] == [row[:4] for row in sorted(expected, key=repr)]
    assert sorted(map(repr, map(sorted, (row[4] for row in got)))) == sorted(map(repr, map(sorted, (row[4] for row in expected))))


def test_report_equals_brute_force(spark):
    rows, bench = document_rows(), benchmark_rows()
    benchmark = spark.createDataFrame(bench, "item_id long, text string")
    got = decontaminate.contamination_report(fixtures.awkward(spark, rows), benchmark).collect()
    expected = [(row[0], *fixtures.contamination(row[1], bench)) for row in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


def test_random_strings_against_brute_force():
    rng = random.Random(2)
    for _ in range(200):
        alphabet = "abc"[: rng.randrange(1, 4)]
        items = [(str(k), " ".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 9)))) for k in range(4)]
        text = " ".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 40)))
        spans, found = decontaminate.hits(text.split(), decontaminate.build_tables(items, window=4))
        n_words, n_hit, n_items, _, _ = fixtures.contamination(text, items, window=4)
        assert (sum(b - a for a, b in spans), len(found)) == (n_hit, n_items)


def test_clean_documents_stay(spark):
    bench = spark.createDataFrame([(1, fixtures.prose(900, 30))], "item_id long, text string")
    rows = document_rows()
    docs = fixtures.awkward(spark, rows)
    kept = decontaminate.drop_contaminated(docs, bench)
    expected = [row[0] for row in rows if not fixtures.contamination(row[1], [(1, fixtures.prose(900, 30))])[4]]
    assert kept.columns == docs.columns
    assert sorted(map(repr, (row.doc_id for row in kept.collect()))) == sorted(map(repr, expected))
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.drop_contaminated(docs, empty).count() == len(rows)
    assert decontaminate.contamination_report(fixtures.awkward(spark, []), bench).collect() == []
