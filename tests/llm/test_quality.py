from __future__ import annotations

import pytest

import fixtures
from tallyforge.llm import quality
from tallyforge.llm.quality import Document, Rule, Trial


def test_report_equals_brute_force(spark):
    rows = fixtures.awkward_rows()
    got = quality.quality_report(fixtures.awkward(spark)).collect()
    assert len(got) == len(rows)
    expected = sorted(((row[0], *fixtures.counts(row[1])) for row in rows), key=repr)
    assert sorted((tuple(row)[:6] for row in got), key=repr) == expected
    for row in got:
        assert row.base_failed == (row.n_words < 50 or 100 * row.n_repeat_words > 50 * row.n_words)
        assert not (row.base_failed and row.kept)


def test_order_does_not_change_the_verdict():
    forward, backward = list(quality.RULES), list(quality.RULES)[::-1]
    for _, text, *_ in fixtures.awkward_rows():
        verdicts = {quality.first_rejection(Document(text), rules) is None for rules in (forward, backward)}
        assert len(verdicts) == 1


def test_prose_is_kept_and_junk_is_not(spark):
    good, junk = fixtures.prose(5, 300), " ".join(f"w{k}%%% a{k}***" for k in range(200))
    docs = spark.createDataFrame([(1, good), (2, junk), (3, good.upper())], "doc_id long, text string")
    assert [row.doc_id for row in quality.keep_good(docs).collect()] == [1]


def test_cheap_and_strict_rules_come_first():
    rules = [Rule("slow", lambda doc: True), Rule("fast", lambda doc: True), Rule("rare", lambda doc: False)]
    trials = [[Trial(100, True), Trial(10, True), Trial(1, False)]] * 5
    assert [rule.name for rule in quality.order_rules(trials, rules)] == ["fast", "slow", "rare"]


def test_order_counts_only_what_earlier_rules_leave():
    rules = [Rule("a", None), Rule("same", None), Rule("other", None)]
    # "same" rejects what "a" rejects; "other" rejects fewer rows, but different ones.
    rejected = [(1, 1, 0), (1, 1, 0), (1, 1, 0), (0, 0, 1)]
    trials = [[Trial(10, bool(x)) for x in row] for row in rejected]
    assert [rule.name for rule in quality.order_rules(trials, rules)] == ["a", "other", "same"]


def test_cascade_stops_at_the_first_rejection():
    seen = []
    rules = [Rule("first", lambda doc: True), Rule("second", lambda doc: seen.append(doc) or True)]
    assert quality.first_rejection(Document("x"), rules) == "first" and not seen


def test_empty_table_and_unchanged_columns(spark):
    docs = fixtures.awkward(spark, [])
    assert quality.quality_report(docs).collect() == []
    assert quality.keep_good(docs).schema == docs.schema
    kept = quality.keep_good(fixtures.awkward(spark))
    assert kept.columns == docs.columns and kept.count() > 0


@pytest.mark.parametrize("text", ["a a a", "a b a b a b", "x y z x y", "x y z w x y z", "a b c d"])
def test_repeated_words(text):
    assert Document(text).n_repeat_words == fixtures.counts(text)[4]
