from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import fixtures
from tallyforge.llm import mixing


def targets(sizes: dict, weights=(5, 2, 1), share=1.5, most=2) -> dict:
    """Shares by weight, the excess over the limits shared again until nothing is above."""
    names = sorted((name for name in sizes if name is not None)) + [name for name in sizes if name is None]
    weight = {name: weights[k % len(weights)] for k, name in enumerate(names)}
    left, found, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        level = left / sum(weight[name] for name in open_)
        full = {name for name in open_ if weight[name] * level >= most * sizes[name]}
        if not full:
            return found | {name: weight[name] * level for name in open_}
        for name in full:
            found[name] = most * sizes[name]
            left -= found[name]
        open_ -= full
    return found


def many_rows():
    sources = ["news", "books", None, "web", "code", "", "Zeit"]
    return [
        (k, fixtures.prose(k, 5 + (k * k) % 90), None, sources[(k * k + k) % len(sources)] if k % 3 else "web", None)
        for k in range(240)
    ]


@pytest.mark.parametrize("rows", [many_rows(), fixtures.awkward_rows()], ids=["many", "awkward"])
def test_report(spark, rows):
    got = mixing.mix_report(fixtures.scanned(spark, fixtures.awkward(spark, rows))).collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for row in rows:
        sizes[row[3]] += len(fixtures.words(row[1]))
    expected = targets(sizes)
    assert sorted(map(repr, ((r.doc_id, r.size) for r in got))) == sorted(
        map(repr, ((row[0], len(fixtures.words(row[1]))) for row in rows))
    )
    for row in got:
        taken[row.source] += row.taken
        assert 0 <= row.taken <= 2 * row["size"] and row.source_size == sizes[row.source]
        assert row.target == pytest.approx(expected[row.source])
    total = 1.5 * sum(sizes.values())
    assert all(taken[name] == pytest.approx(expected[name], abs=2 + 0.001 * total) for name in sizes)


def test_reruns_agree_and_partitioning_does_not_matter(spark):
    rows = many_rows()
    one = fixtures.scanned(spark, fixtures.awkward(spark, rows).coalesce(1))
    many = fixtures.scanned(spark, fixtures.awkward(spark, rows).repartition(7))
    results = [sorted(map(repr, mixing.mix_report(docs).collect())) for docs in (one, one, many)]
    assert results[0] == results[1] == results[2]


def test_schedule_is_even(spark):
    frame = spark.createDataFrame(
        [("a", 0, 100, 50.0), ("b", 1, 100, 30.0), ("c", 2, 100, 0.0), ("d", 3, 100, 20.0)],
        "source string, number int, source_size long, target double",
    )
    rows = sorted(mixing.schedule(spark, frame, 1000).collect(), key=lambda row: row["slot"])
    assert [row["slot"] for row in rows] == list(range(1000))
    seen = defaultdict(int)
    for done, row in enumerate(rows, 1):
        assert row["rank"] == seen[row["number"]]
        seen[row["number"]] += 1
        assert all(abs(seen[k] - done * share) < 6 for k, share in ((0, 0.5), (1, 0.3), (3, 0.2)))
    assert seen[2] == 0


def test_documents_come_as_often_as_taken(spark):
    rows = many_rows()
    docs = fixtures.scanned(spark, fixtures.awkward(spark, rows))
    copies = defaultdict(int)
    for row in mixing.mixed_documents(docs).collect():
        copies[row.doc_id] += 1
        assert row.text == rows[row.doc_id][1]
    for row in mixing.mix_report(docs).collect():
        assert copies[row.doc_id] == -(-row.taken // max(1, row["size"]))


def test_no_words_at_all(spark):
    for rows in ([], [(1, None, None, "a", None), (2, " ", None, None, None)]):
        docs = fixtures.scanned(spark, fixtures.awkward(spark, rows))
        got = mixing.mix_report(docs).collect()
        assert len(got) == len(rows) and all(row["size"] == row.target == row.taken == 0 for row in got)
        assert mixing.mixed_documents(docs).columns == docs.columns and mixing.mixed_documents(docs).isEmpty()


def test_sources_smaller_than_a_block_get_their_targets(spark):
    """The large sources make blocks of 90 words; the small ones have fewer words than that."""
    rows = [(k, "a " * 100_000, None, "ab"[k % 2], None) for k in range(40)]
    rows += [(100 + k, "b " * (3 + 8 * k), None, f"small {k}", None) for k in range(6)]
    docs = fixtures.scanned(spark, fixtures.awkward(spark, rows).repartition(8))
    report = mixing.mix_report(docs).collect()
    taken, wanted = defaultdict(int), {}
    for row in report:
        taken[row.source] += row.taken
        wanted[row.source] = row.target
        assert 0 <= row.taken <= 2 * row["size"]
    assert len(wanted) == 8 and all(abs(taken[name] - wanted[name]) <= 0.5 for name in wanted)
    assert {row.source for row in mixing.mixed_documents(docs).select("source").distinct().collect()} == set(wanted)


def expected_schedule(table, slots):
    """Slots by brute force: (source number, rank) in the order of the mix."""
    golden = (5**0.5 - 1) / 2
    total, upto, ends = sum(row[3] for row in table), 0.0, []
    for row in table:
        ends.append((upto / total, (upto + row[3]) / total, row[1]))
        upto += row[3]
    places = [(float(i), n) for i in range(slots) for low, high, n in ends if low <= i * golden % 1 < high]
    for row in table:
        if round(row[3]) >= 1 and all(n != row[1] for _, n in places):
            places.append((row[1] * golden % 1 * slots // 1 + 0.5, row[1]))
    seen, made = defaultdict(int), []
    for _, number in sorted(places):
        made.append((number, seen[number]))
        seen[number] += 1
    return made


@pytest.mark.parametrize("slots", [1, 7, 300])
def test_schedule_equals_brute_force(spark, slots):
    table = [("a", 0, 9, 12.5), ("b", 1, 9, 0.0), ("c", 2, 1, 1.0), ("d", 3, 90, 88.25), ("e", 4, 1, 0.2), ("f", 5, 2, 1.0)]
    frame = spark.createDataFrame(table, "source string, number int, source_size long, target double")
    rows = sorted(mixing.schedule(spark, frame, slots).collect(), key=lambda row: row["slot"])
    assert [(row["number"], row["rank"]) for row in rows] == expected_schedule(table, slots)
    assert [row["slot"] for row in rows] == list(range(len(rows)))


def test_the_mix_comes_through_the_schedule(spark):
    """Another sequence of points gives other slots, and what is not scheduled is not taken."""
    sized = mixing.sized_rows(fixtures.scanned(spark, fixtures.awkward(spark, many_rows())))
    report = mixing.mix(sized).collect()
    table = mixing.source_targets(sized)
    slots = mixing.slot_count(table)
    golden = mixing.schedule(spark, table, slots).collect()
    corput = mixing.schedule(spark, table, slots, lambda i: F.conv(F.reverse(F.lpad(F.bin(i), 20, "0")), 2, 10).cast("double") / (1 << 20))
    assert sorted((row.slot, row.number) for row in corput.collect()) != sorted((row.slot, row.number) for row in golden)
    planned = mixing.schedule(spark, table, slots)
    found = mixing.blocks(sized, table, planned)
    whole = found.join(planned, ["number", "rank"]).agg(F.sum("words")).first()[0]
    half = found.join(planned.filter("slot % 2 = 0"), ["number", "rank"]).agg(F.sum("words")).first()[0]
    assert whole == sum(row.taken for row in report) and 0.4 * whole < half < 0.6 * whole
    # Blocks of a source are equal within a word.
    sizes = defaultdict(set)
    for row in found.groupBy("number", "rank").agg(F.sum("words").alias("words")).collect():
        sizes[row.number].add(row.words)
    assert all(max(found) - min(found) <= 1 for found in sizes.values())


def test_first_slots_are_where_the_mix_first_uses_a_document(spark):
    rows = many_rows()
    report = mixing.mix_report(fixtures.scanned(spark, fixtures.awkward(spark, rows))).collect()
    assert all((row.first_slot is None) == (row.taken == 0) for row in report)
    # Every source comes early, whatever its share.
    sources = {row.source for row in report if row.taken}
    early = sorted((row for row in report if row.taken), key=lambda row: row.first_slot)[: len(report) // 4]
    assert {row.source for row in early} == sources


def test_many_words_and_slots_stay_within_64_bits(spark):
    schema = "scan_row long, key long, source string, size long, shuffle long"
    sized = mixing.materialize(spark.createDataFrame([(k, k, "ab"[k % 2], 10**15 + k, k) for k in range(6)], schema))
    targets = mixing.materialize(mixing.source_targets(sized))
    planned = mixing.materialize(mixing.schedule(spark, targets, 5000))
    taken = {row.number: row.words for row in mixing.blocks(sized, targets, planned).groupBy("number").agg(F.sum("words").alias("words")).collect()}
    assert taken == {row.number: round(row.target) for row in targets.collect()}


def test_single_slots_lie_apart(spark):
    table = [(f"s{k:02}", k, 1, 1.0) for k in range(32)] + [("big", 32, 100_000, 100_000.0)]
    frame = spark.createDataFrame(table, "source string, number int, source_size long, target double")
    rows = mixing.schedule(spark, frame, 1000).collect()
    assert sorted(row["slot"] for row in rows) == list(range(len(rows)))
    places = sorted(row["slot"] for row in rows if row["number"] < 32)
    assert len(places) == 32 and max(b - a for a, b in zip([0, *places], [*places, len(rows)])) < 100
