from __future__ import annotations

import random
from collections import Counter, defaultdict

import fixtures
from tallyforge.llm import sharding


def check(rows, got, shards=8):
    assert sorted(map(repr, ((r.doc_id, r.size, r.text_crc32) for r in got))) == sorted(
        map(repr, ((row[0], len((row[1] or "").encode()) + 1, fixtures.crc(row[1])) for row in rows))
    )
    slots = defaultdict(list)
    for row in got:
        slots[row.shard].append(row.slot)
        assert row.law == "bytes" and row.grown_shard is None and 0 <= row.shard < shards
    assert all(sorted(found) == list(range(len(found))) for found in slots.values())


def test_awkward_rows(spark):
    rows = fixtures.awkward_rows()
    got = sharding.shard_report(fixtures.scanned(spark, fixtures.awkward(spark))).collect()
    check(rows, got)
    groups = defaultdict(set)
    for row in got:
        groups[row.text_crc32].add(row.shard)
    assert all(len(found) == 1 for found in groups.values())


def test_same_as_longest_first_of_all_groups(spark):
    rows = [(k, "x" * (37 * k % 101) + str(k), None, None, None) for k in range(300)]
    docs = fixtures.scanned(spark, fixtures.awkward(spark, rows))
    loads = defaultdict(int)
    for row in sharding.shard_report(docs).collect():
        loads[row.shard] += row.size
    sizes = sorted((len(row[1].encode()) + 1 for row in rows), reverse=True)
    best = [0] * 8
    for size in sizes:
        best[best.index(min(best))] += size
    assert sorted(loads.values()) == sorted(best)


def test_runs_equal_longest_first_one_by_one():
    rng = random.Random(4)
    for shards in (1, 2, 3, 8):
        for _ in range(60):
            sizes = [rng.choice([1, 2, 3, 50, 51, 1000, 2047]) for _ in range(rng.randrange(1, 90))]
            counted = Counter(sizes)
            placed = [0] * shards
            for step, first, ranks, turn in sharding.longest_first(((s, n, s * n) for s, n in counted.items()), shards):
                for rank in range(ranks):
                    placed[turn[rank % len(turn)]] += step
                counted[step] -= ranks
                assert first + ranks + counted[step] == Counter(sizes)[step]
            best = [0] * shards
            for size in sorted(sizes, reverse=True):
                best[best.index(min(best))] += size
            assert sorted(placed) == sorted(best) and not any(counted.values())


def test_steps_keep_the_order_of_sizes(spark):
    sizes = sorted({*range(1, 3000, 7), *(1 << k for k in range(45)), *((1 << k) + (1 << k) // 3 for k in range(45))})
    frame = spark.createDataFrame([(size,) for size in sizes], "bytes long").select("bytes", sharding.size_step("bytes").alias("step"))
    steps = [row.step for row in frame.orderBy("bytes").collect()]
    assert steps == sorted(steps) and steps[: len([s for s in sizes if s < 2048])] == [s for s in sizes if s < 2048]
    assert len({row.step for row in frame.filter("bytes between 1048576 and 2097151").collect()}) <= 1024


def test_large_groups_of_like_size_stay_together_and_sizes_come_near(spark):
    rows = [(k, fixtures.prose(k % 200, 20 + k % 7), None, None, None) for k in range(600)]
    sized = sharding.sized_rows(fixtures.scanned(spark, fixtures.awkward(spark, rows)))
    placed = sharding.shard_rows(sized, shards=4).collect()
    loads, groups = defaultdict(int), defaultdict(set)
    for row in placed:
        loads[row.shard] += row.size
        groups[row.text_crc32].add(row.shard)
    assert all(len(found) == 1 for found in groups.values())
    assert max(loads.values()) - min(loads.values()) < 0.1 * sum(loads.values()) / 4


def test_one_group_holds_a_third(spark):
    rows = [(k, "the same text" if k % 3 == 0 else f"text {k}", None, None, None) for k in range(90)]
    got = sharding.shard_report(fixtures.scanned(spark, fixtures.awkward(spark, rows))).collect()
    check(rows, got)
    assert len({row.shard for row in got if row.doc_id % 3 == 0}) == 1


def test_documents_keep_their_columns(spark):
    docs = fixtures.scanned(spark, fixtures.awkward(spark))
    out = sharding.sharded_documents(docs)
    assert set(out.columns) == set(docs.columns) and out.count() == docs.count()
    assert dict(out.dtypes)["shard"] == "int"
    assert sharding.shard_report(fixtures.scanned(spark, fixtures.awkward(spark, []))).collect() == []
