from __future__ import annotations

from datetime import date, datetime

import pytest

from tallyforge.operators.history import history_partition, next_versions, take_snapshot
from tallyforge.sources.published import PublishedTable

SCHEMA = "membership_id bigint, tier string, guild_id int, valid_to date, note string"
CHECKED = ["tier", "guild_id", "valid_to"]
T1, T2, T3 = datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1, 6, 30)


@pytest.fixture
def table(spark, tmp_path):
    return PublishedTable(spark, str(tmp_path / "history"), history_partition("membership_id", 4))


def frame(spark, *data):
    return spark.createDataFrame([row + ("n",) * (5 - len(row)) for row in data], SCHEMA)


def snap(table, source, at, **options):
    take_snapshot(table, source, "membership_id", CHECKED, at, **options)


def versions(rows, table):
    return rows(table.read(), "membership_id", "tier", "version_from", "version_to")


def test_first_snapshot_opens_every_row(spark, table, rows):
    snap(table, frame(spark, (1, "adept", 5, None), (2, "adept", 5, None)), T1)
    assert versions(rows, table) == [(1, "adept", T1, None), (2, "adept", T1, None)]


def test_replay_adds_nothing(spark, table, rows):
    source = frame(spark, (1, "adept", 5, None), (2, None, None, date(2024, 1, 1)))
    snap(table, source, T1)
    before = rows(table.read())
    snap(table, source, T2)
    assert rows(table.read()) == before


def test_changed_row_closes_and_reopens_at_the_same_instant(spark, table, rows):
    snap(table, frame(spark, (1, "adept", 5, None)), T1)
    snap(table, frame(spark, (1, "archmage", 5, None)), T2)
    assert versions(rows, table) == [(1, "adept", T1, T2), (1, "archmage", T2, None)]


@pytest.mark.parametrize("row", [(1, "adept", 6, None), (1, "adept", 5, date(2024, 1, 31)), (1, None, 5, None)])
def test_each_check_column_counts_and_null_is_a_value(spark, table, rows, row):
    snap(table, frame(spark, (1, "adept", 5, None)), T1)
    snap(table, frame(spark, row), T2)
    assert [v[3] for v in versions(rows, table)] == [T2, None]


def test_other_columns_do_not_open_a_version(spark, table, rows):
    snap(table, frame(spark, (1, "adept", 5, None, "old")), T1)
    snap(table, frame(spark, (1, "adept", 5, None, "new")), T2)
    assert rows(table.read(), "note", "version_to") == [("old", None)]


def test_deleted_key_is_closed_and_may_return(spark, table, rows):
    row = (1, "adept", 5, None)
    snap(table, frame(spark, row, (2, "adept", 5, None)), T1)
    snap(table, frame(spark, (2, "adept", 5, None)), T2)
    snap(table, frame(spark, row, (2, "adept", 5, None)), T3)
    assert versions(rows, table) == [(1, "adept", T1, T2), (1, "adept", T3, None), (2, "adept", T1, None)]


def test_deletes_can_be_ignored(spark, table, rows):
    snap(table, frame(spark, (1, "adept", 5, None)), T1)
    snap(table, frame(spark), T2, invalidate_deletes=False)
    assert versions(rows, table) == [(1, "adept", T1, None)]


def test_closed_versions_are_not_rewritten(spark, table):
    for at, tier in ((T1, "a"), (T2, "b"), (T3, "c")):
        snap(table, frame(spark, (1, tier, 5, None)), at)
        closed = table.manifest().dirs.get("closed", [])
    assert len(closed) == 2


def test_one_open_version_per_key_and_unique_version_ids(spark, table):
    for at, tier in ((T1, "a"), (T2, "b"), (T3, "a")):
        snap(table, frame(spark, *((i, tier if i % 2 else "z", 5, None) for i in range(20))), at)
    history = table.read()
    open_counts = history.filter("version_to is null").groupBy("membership_id").count()
    assert open_counts.filter("count <> 1").isEmpty() and open_counts.count() == 20
    assert history.select("version_id").distinct().count() == history.count() == 40


@pytest.mark.parametrize(("data", "message"), [([(1, "a", 5, None), (1, "b", 5, None)], "repeats"), ([(None, "a", 5, None)], "NULL")])
def test_bad_keys_are_refused(spark, table, data, message):
    with pytest.raises(ValueError, match=message):
        snap(table, frame(spark, *data), T1)
    assert not table.exists()


def test_one_shuffle_join(spark, table, capsys):
    snap(table, frame(spark, (1, "adept", 5, None)), T1)
    source = frame(spark, (1, "adept", 5, None))
    next_versions(table.read(["open"]), source, "membership_id", CHECKED, T2).explain()
    plan = capsys.readouterr().out
    assert plan.count("FullOuter") == 1


def test_an_older_or_equal_instant_with_changes_is_refused(spark, table, rows):
    snap(table, frame(spark, (1, "a", 5, None)), T2)
    before = rows(table.read())
    for at in (T1, T2):
        with pytest.raises(ValueError, match="not later"):
            snap(table, frame(spark, (1, "b", 5, None)), at)
        snap(table, frame(spark, (1, "a", 5, None)), at)
    assert rows(table.read()) == before
    snap(table, frame(spark, (1, "a", 5, None)), T3)
    with pytest.raises(ValueError, match="not later"):
        snap(table, frame(spark, (1, "b", 5, None)), T3)


def test_unchanged_buckets_are_not_rewritten(spark, table):
    data = [(k, "a", 5, None) for k in range(40)]
    snap(table, frame(spark, *data), T1)
    before = table.manifest().dirs
    snap(table, frame(spark, (0, "b", 5, None), *data[1:]), T2)
    after = table.manifest().dirs
    assert sum(before[part] != after[part] for part in before) == 1 and len(before) == 4
    assert table.read().filter("version_to is null").count() == 40 and len(after["closed"]) == 1
