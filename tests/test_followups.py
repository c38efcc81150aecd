"""Rollups, checks and distinct counts that follow changes; late extracts, drops and damaged extracts."""

from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyforge.operators.bitmaps import distinct_bitmaps, distinct_counts
from tallyforge.operators.checks import AcceptedValues, NotNull, Relationship, Unique, run_checks
from tallyforge.operators.followed import FollowedChecks
from tallyforge.operators.history import history_of_extracts, history_partition, insert_snapshot, load_extracts, take_snapshot
from tallyforge.operators.pivots import TooManyValues, discover_values, pivot_present_values, sums_in_rows
from tallyforge.operators.rollups import MaintainedRollup
from tallyforge.sources.extracts import split_csv
from tallyforge.sources.published import PublishedTable
from tallyforge.streaming.drops import latest_per_key, load_drops, merge_batch

SCHEMA = "id bigint, grp string, amount bigint, label string"


def frame(spark, data):
    return spark.createDataFrame(list(data), SCHEMA)


def some_rows(seed, count=60, keys=200):
    rng = random.Random(seed)
    ids = rng.sample(range(keys), count)
    pick = lambda: rng.choice(["a", "b", "c", None])
    return [(k, pick(), rng.choice([None, *range(9)]), rng.choice(["x", "y", "z", None])) for k in ids]


# Rollups


def rollup(table, path):
    amount = F.col("amount")
    return MaintainedRollup(
        table,
        str(path),
        ["grp"],
        {"total": amount, "large": F.when(amount > 4, 1).otherwise(0)},
        least={"first_label": F.col("label")},
        most={"most": amount},
    )


def rolled(df):
    return df.groupBy("grp").agg(
        F.count(F.lit(1)).alias("rollup_rows"),
        F.sum("amount").alias("total"),
        F.sum(F.when(F.col("amount") > 4, 1).otherwise(0)).alias("large"),
        F.min("label").alias("first_label"),
        F.max("amount").alias("most"),
    )


def test_a_maintained_rollup_equals_the_full_one_after_every_change(spark, tmp_path, rows):
    table = PublishedTable(spark, str(tmp_path / "t"), keys=["id"], file_rows=10)
    kept = rollup(table, tmp_path / "r")
    steps = [
        lambda: table.replace(frame(spark, some_rows(1))),
        lambda: table.upsert(frame(spark, some_rows(2, 30)), ["id"]),
        lambda: table.upsert_on_read(frame(spark, some_rows(3, 20))),
        lambda: table.delete_on_read(frame(spark, some_rows(4, 50)).select("id")),
        lambda: table.append(frame(spark, some_rows(5, 5))),
        lambda: table.compact(0),
        lambda: table.delete_on_read(table.read().filter("grp = 'a'").select("id")),  # a group disappears
        lambda: table.upsert(frame(spark, [(k, g, 3, "new") for k, g, *_ in some_rows(6, 10)]), ["id"]),
        lambda: table.replace(frame(spark, some_rows(7, 9))),
    ]
    for step in steps:
        step()
        kept.refresh()
        assert rows(kept.read(), "grp", "rollup_rows", "total", "large", "first_label", "most") == rows(rolled(table.read()))
    version = kept.state.manifest().version
    kept.refresh()
    assert kept.state.manifest().version == version


def test_a_refresh_reads_and_writes_touched_groups_only(spark, tmp_path, rows):
    table = PublishedTable(spark, str(tmp_path / "t"), keys=["id"])
    table.replace(spark.range(5000).selectExpr("id", "concat('g', id % 1000) as grp", "id as amount", "'x' as label"))
    kept = rollup(table, tmp_path / "r")
    kept.refresh()
    table.upsert_on_read(frame(spark, [(7, "g7", -1, "w"), (8, "other", 1, "w")]))
    kept.refresh()
    newest = [entry for entry in kept.state.manifest().entries if entry.since == 2]
    assert sum(entry.rows for entry in newest) == 3  # g7, g8 and the new group
    assert rows(kept.read(), "grp", "rollup_rows", "total", "large", "first_label", "most") == rows(rolled(table.read()))


def test_a_rollup_is_rebuilt_where_its_version_has_expired(spark, tmp_path, rows):
    from datetime import timedelta

    table = PublishedTable(spark, str(tmp_path / "t"), keys=["id"])
    table.replace(frame(spark, some_rows(1)))
    kept = rollup(table, tmp_path / "r")
    kept.refresh()
    table.upsert(frame(spark, some_rows(2)), ["id"])
    table.expire(keep=1, min_age=timedelta(0))
    kept.refresh()
    assert rows(kept.read(), "grp", "rollup_rows", "total", "large", "first_label", "most") == rows(rolled(table.read()))


# Checks


CHECKS = (Unique(("id",)), Unique(("grp", "label")), NotNull("amount"), AcceptedValues("label", ("x", "y")))


def test_followed_checks_equal_a_full_run(spark, tmp_path, rows):
    table = PublishedTable(spark, str(tmp_path / "t"), F.col("grp"), keys=["id"], file_rows=10)
    followed = FollowedChecks("t", table, CHECKS, str(tmp_path / "checks"))
    steps = [
        lambda: table.replace(frame(spark, some_rows(1, 12))),
        lambda: table.append(frame(spark, some_rows(1, 12)[:4])),
        lambda: table.upsert_on_read(frame(spark, some_rows(8, 6))),
        lambda: table.append(frame(spark, [(None, None, None, None)] * 2)),
        lambda: table.delete_on_read(frame(spark, some_rows(1, 12)).select("id")),
    ]
    for step in steps:
        step()
        followed.refresh()
        assert rows(followed.read()) == rows(run_checks({"t": table.read()}, {"t": CHECKS}))
    with pytest.raises(ValueError, match="relationships"):
        FollowedChecks("t", table, [Relationship("id", "p", "id")], str(tmp_path / "other"))


def test_followed_checks_read_changed_and_colliding_files_only(spark, tmp_path, monkeypatch):
    table = PublishedTable(spark, str(tmp_path / "t"), F.col("grp"), keys=["id"])
    table.replace(spark.range(1200).selectExpr("id", "concat('m', id div 100) as grp", "id as amount", "'x' as label"))
    followed = FollowedChecks("t", table, (Unique(("id",)), NotNull("amount")), str(tmp_path / "checks"))
    followed.refresh()
    table.append(frame(spark, [(k, "m12", None, "x") for k in (1200, 1201, 305)]))
    seen, scan = set(), table._scan
    monkeypatch.setattr(table, "_scan", lambda entries, at: seen.update(e.directory.rpartition("=")[2] for e in entries) or scan(entries, at))
    followed.refresh()
    assert seen == {"m12", "m3"}
    assert {row.check_name: row.failures for row in followed.read().collect()} == {"unique": 1, "not_null": 3}


# Distinct counts


def test_bitmaps_merge_to_exact_counts(spark, tmp_path, rows):
    source = spark.range(40_000).selectExpr("id % 7 as region", "id % 12 as month", "(id * 7919) % 90001 - 5 as person")
    source = source.unionByName(source.limit(50).withColumn("person", F.lit(None).cast("bigint")))
    table = PublishedTable(spark, str(tmp_path / "bits"))
    for part in range(3):
        table.append(distinct_bitmaps(source.filter(F.col("month") % 3 == part), ["region", "month"], "person"))
    quarter = {"region": F.col("region"), "quarter": F.floor(F.col("month") / 3)}
    expected = source.groupBy("region", F.floor(F.col("month") / 3).alias("quarter")).agg(F.countDistinct("person").alias("people"))
    assert rows(distinct_counts(table.read(), quarter, "people")) == rows(expected)
    with pytest.raises(TypeError):
        distinct_bitmaps(source.selectExpr("region", "string(person) as person"), ["region"], "person")


# Late extracts


T = [datetime(2024, 1, day) for day in (1, 8, 15, 22, 29)]
MEMBERS = "membership_id bigint, tier string, guild_id bigint, note string"
CHECKED = ["tier", "guild_id"]


def extract(spark, seed):
    rng = random.Random(seed)
    data = [(k, rng.choice("ab"), rng.choice([1, None]), "n") for k in range(25) if rng.random() < 0.8]
    return spark.createDataFrame(data, MEMBERS)


def history(spark, path):
    return PublishedTable(spark, str(path), history_partition("membership_id", 4))


@pytest.mark.parametrize("order", [(0, 1, 2, 3, 4), (0, 4, 2, 1, 3), (4, 3, 2, 1, 0), (2, 0, 4, 3, 1)])
def test_extracts_in_any_order_give_the_same_history(spark, tmp_path, rows, order):
    extracts = [extract(spark, seed) for seed in range(5)]
    straight = history(spark, tmp_path / "straight")
    for at, source in zip(T, extracts):
        take_snapshot(straight, source, "membership_id", CHECKED, at)
    mixed = history(spark, tmp_path / "mixed")
    for place in order:
        insert_snapshot(mixed, extracts[place], "membership_id", CHECKED, T[place])
    columns = straight.read().columns
    assert rows(mixed.read(), *columns) == rows(straight.read(), *columns)
    dated = [source.withColumn("at", F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")) for at, source in zip(T, extracts)]
    whole = dated[0]
    for one in dated[1:]:
        whole = whole.unionByName(one)
    assert rows(history_of_extracts(whole, "membership_id", CHECKED, "at"), *columns) == rows(straight.read(), *columns)
    once = history(spark, tmp_path / "once")
    load_extracts(once, whole, "membership_id", CHECKED, "at")
    take_snapshot(once, extracts[0], "membership_id", CHECKED, datetime(2024, 3, 1))
    take_snapshot(straight, extracts[0], "membership_id", CHECKED, datetime(2024, 3, 1))
    assert rows(once.read(), *columns) == rows(straight.read(), *columns)


def test_the_same_time_twice(spark, tmp_path, rows):
    table = history(spark, tmp_path / "h")
    for place in (0, 1, 2):
        take_snapshot(table, extract(spark, place), "membership_id", CHECKED, T[place])
    before = rows(table.read())
    insert_snapshot(table, extract(spark, 1), "membership_id", CHECKED, T[1])
    assert rows(table.read()) == before
    with pytest.raises(ValueError, match="another extract"):
        insert_snapshot(table, extract(spark, 9), "membership_id", CHECKED, T[1])


def test_a_snapshot_writes_in_proportion_to_its_changes(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path / "h"), history_partition("membership_id"), keys=["membership_id"])
    source = spark.range(100_000).selectExpr("id as membership_id", "'a' as tier", "id as guild_id", "uuid() as note")
    take_snapshot(table, source, "membership_id", CHECKED, T[0])
    size = sum(entry.rows for entry in table.manifest().entries)
    changed = source.withColumn("tier", F.expr("if(membership_id % 10000 = 3, 'b', tier)"))
    take_snapshot(table, changed, "membership_id", CHECKED, T[1])
    written = sum(entry.rows for entry in table.manifest().entries if entry.since == 2)
    assert size == 100_000 and written == 20
    assert table.read().count() == 100_010 and table.read().filter("version_to is null").count() == 100_000


def test_many_snapshots_fold_their_deletes(spark, tmp_path, rows):
    table = history(spark, tmp_path / "h")
    for day in range(12):
        take_snapshot(table, extract(spark, day), "membership_id", CHECKED, datetime(2024, 1, 1 + day))
    assert len(table.manifest().deletes) < 8
    keys = table.read().filter("version_to is null").groupBy("membership_id").count()
    assert keys.filter("count > 1").isEmpty() and keys.count() == extract(spark, 11).count()


# Drops


def test_drops_and_replayed_batches(spark, tmp_path, rows):
    table = PublishedTable(spark, str(tmp_path / "t"), keys=["id"])
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    drops = [some_rows(1, 30), some_rows(2, 30), some_rows(3, 30)]
    expected = {}
    for place, drop in enumerate(drops):
        frame(spark, drop).write.mode("append").parquet(landing)
        load_drops(spark, landing, SCHEMA, "parquet", lambda raw: raw, table, checkpoint, ["id"], "amount", 100, place == 1)
        expected |= {row[0]: row for row in drop}
        assert rows(table.read()) == sorted(expected.values(), key=repr)
    version = table.manifest().version
    load_drops(spark, landing, SCHEMA, "parquet", lambda raw: raw, table, checkpoint, ["id"], "amount")
    assert table.manifest().version == version
    assert not merge_batch(table, frame(spark, [(1, "late", 1, "x")]), 2, checkpoint, ["id"], "amount")
    assert rows(table.read()) == sorted(expected.values(), key=repr)
    assert merge_batch(table, frame(spark, [(1, "late", 1, "x")]), 3, checkpoint, ["id"], "amount")


def test_the_latest_row_of_a_key_counts(spark, rows):
    data = [(1, "a", 5, "x"), (1, "b", 7, "x"), (1, "c", None, "x"), (2, "a", None, None), (None, "a", 1, "x"), (None, "a", 1, "x")]
    got = latest_per_key(frame(spark, data), ["id"], "amount")
    assert rows(got) == sorted([(1, "b", 7, "x"), (2, "a", None, None), (None, "a", 1, "x"), (None, "a", 1, "x")], key=repr)


# Damaged extracts


def test_damaged_lines_are_set_aside_with_their_reason(spark, tmp_path, rows):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text('id,name,amount\n1,"x, y",5\n2,short\n3,z,notanumber\n4,a,1,extra\n')
    (folder / "b.csv").write_text('id,name,amount\n5,,\n"oops""quoted, text",w,6\n6,"q",7\n')
    split = split_csv(spark, str(folder), "id bigint, name string, amount int")
    assert rows(split.rows) == sorted([(1, "x, y", 5), (5, None, None), (6, "q", 7)], key=repr)
    assert rows(split.quarantine, "line_text", "reason") == sorted(
        [
            ("2,short", "too few fields"),
            ("3,z,notanumber", "value of another type"),
            ("4,a,1,extra", "too many fields"),
            ('"oops""quoted, text",w,6', "value of another type"),
        ]
    )
    assert {row.source_file.rpartition("/")[2] for row in split.quarantine.collect()} == {"a.csv", "b.csv"}
    assert tuple(split.balance().first()) == (7, 3, 4)
    # A reading of one column still knows of damage in the others.
    assert split.rows.select("id").count() == 3


def test_a_header_that_disagrees_is_refused(spark, tmp_path):
    (tmp_path / "g.csv").write_text("id,title,amount\n1,x,5\n")
    with pytest.raises(Exception, match="(?i)header"):
        split_csv(spark, str(tmp_path / "g.csv"), "id bigint, name string, amount int")


# Pivots


def test_pivots_have_a_bound_and_rows_have_none(spark, monkeypatch, rows):
    from tallyforge.operators import pivots

    source = spark.range(300).selectExpr("id % 3 as g", "concat('v', id) as c", "id as x")
    monkeypatch.setattr(pivots, "MOST_COLUMNS", 100)
    with pytest.raises(TooManyValues):
        pivot_present_values(source, "g", "c", "x")
    with pytest.raises(TooManyValues):
        discover_values(source, "c", [])
    assert sums_in_rows(source, "g", "c", "x").count() == 300
