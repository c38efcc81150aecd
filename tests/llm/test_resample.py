from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import pytest

import fixtures
from tallyforge.llm import resample
from tallyforge.llm.resample import Resampling

BENCHMARK = [fixtures.prose(1, 300), None, "", fixtures.prose(2, 200, 50)]


def brute(rows, target, rule):
    """doc_id, n_features, weight, score and whether drawn, of every row."""

    def runs(text):
        found = fixtures.BENCH_WORDS.findall(fixtures.lower(text or ""))
        made = [" ".join(found[k : k + n]) for n in range(1, rule.longest + 1) for k in range(len(found) - n + 1)]
        return found, [zlib.crc32(run.encode()) % rule.buckets for run in made]

    corpus = Counter(bucket for row in rows for bucket in runs(row[1])[1])
    wanted = Counter(bucket for text in target for bucket in runs(text)[1])
    s, t = sum(corpus.values()), sum(wanted.values())
    gain = [
        math.floor(1000 * math.log((wanted[b] + 1) * (s + rule.buckets) / ((corpus[b] + 1) * (t + rule.buckets))))
        for b in range(rule.buckets)
    ]
    made = []
    for row in rows:
        found, buckets = runs(row[1])
        name = f"{rule.seed}:{'' if row[0] is None else row[0]}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in buckets)
        made.append((row[0], len(found), len(buckets), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((m for m in made if m[1] >= rule.least_words), key=lambda m: (-m[4], m[0] is None, m[0] or 0))
    ranks = able[: rule.percent * len(able) // 100]
    return [m[:1] + m[2:] for m in made], [(m[0], m[4], place) for place, m in enumerate(ranks, 1)]


def tables(spark, rows):
    target = spark.createDataFrame([(str(k), text) for k, text in enumerate(BENCHMARK)], "item_id string, text string")
    return fixtures.scanned(spark, fixtures.awkward(spark, rows).repartition(3)), target


def check(spark, rows, rule):
    docs, target = tables(spark, rows)
    got = resample.resampling_report(docs, target, rule).collect()
    everything, drawn = brute(rows, BENCHMARK, rule)
    assert Counter((r.doc_id, r.n_features, r.weight, r.score) for r in got) == Counter(everything)
    assert sorted((r.rank, r.doc_id, r.score) for r in got if r["rank"]) == sorted((p, d, s) for d, s, p in drawn)
    assert got == [] or resample.resampled_documents(docs, target, rule).columns == docs.columns
    texts = Counter((r.doc_id, r.text) for r in resample.resampled_documents(docs, target, rule).collect())
    assert sum(texts.values()) == len(drawn) and texts <= Counter((row[0], row[1]) for row in rows)


@pytest.mark.parametrize("rule", [Resampling(), Resampling(longest=3, buckets=97, percent=55, least_words=5)])
def test_awkward_rows(spark, rule):
    check(spark, fixtures.awkward_rows(), rule)


def test_many_rows_and_a_wide_first_bracket_that_misses(spark):
    rows = [(k, fixtures.prose(k % 150, 10 + k % 40, 60), None, "a", None) for k in range(400)]
    check(spark, rows, Resampling(percent=37))
    check(spark, rows, Resampling(percent=37, accuracy=2, margin=1e-9))


def test_repeated_rows_and_ids_share_the_cutoff(spark):
    text = fixtures.prose(5, 30)
    check(spark, [(7, text, None, "a", None)] * 40 + [(None, text, None, None, None)] * 9, Resampling(percent=50))


def test_everything_nothing_and_empty_tables(spark):
    rows = [(k, fixtures.prose(k, 30), None, "a", None) for k in range(12)]
    check(spark, rows, Resampling(percent=100))
    check(spark, rows, Resampling(percent=0))
    check(spark, [], Resampling())
    check(spark, [(1, None, None, None, None), (2, "few words", None, None, None)], Resampling())


def test_bracket_is_narrow_and_holds_the_place(spark):
    scores = spark.range(20_000).selectExpr("cast(id * 7919 % 20011 as bigint) as score")
    for place in (1, 2_000, 19_999, 20_000):
        low, high, above = resample.bracket(scores, place, 20_000, Resampling())
        values = sorted((row.score for row in scores.collect()), reverse=True)
        assert above == sum(v > high for v in values) and low <= values[place - 1] <= high
        assert sum(low <= v <= high for v in values) <= 400
