from __future__ import annotations

import os
import uuid
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyforge.operators.checks import AcceptedValues, NotNull, run_checks
from tallyforge.plans.marts import RetailMarts
from tallyforge.settings import Settings
from tallyforge.sources import storage
from tallyforge.sources.driver_tables import DriverTables
from tallyforge.sources.extracts import SCHEMAS, ExtractFolder, read_csv
from tallyforge.sources.published import PART, Bounds, BuildLedger, PublishedTable, RejectedBuild, audited_publish

SCHEMA = "id bigint, grp string, amount bigint"


@pytest.fixture
def table(spark, tmp_path):
    return PublishedTable(spark, str(tmp_path / "table"), F.col("grp"))


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_unpublished_table(table):
    assert not table.exists() and table.partitions() == []
    with pytest.raises(FileNotFoundError):
        table.read()


def test_replace_then_replace(spark, table, rows):
    table.replace(frame(spark, (1, "a", 10), (2, "b", 20)))
    table.replace(frame(spark, (3, "c", 30)))
    assert rows(table.read()) == [(3, "c", 30)]
    assert table.manifest().version == 2


def test_a_table_can_be_rebuilt_from_itself(spark, table, rows):
    table.replace(frame(spark, (1, "a", 10)))
    table.replace(table.read().withColumn("amount", F.col("amount") + 1))
    assert rows(table.read()) == [(1, "a", 11)]


def test_partition_column_stays_hidden(spark, table):
    table.replace(frame(spark, (1, "a", 10)))
    assert table.read().columns == ["id", "grp", "amount"] and PART not in table.read().columns


def test_special_null_and_empty_partition_values(spark, table, rows):
    data = [(1, "a b/c:d=e%", 1), (2, None, 2), (3, "", 3), (4, "é", 4)]
    table.replace(frame(spark, *data))
    assert table.partitions() == sorted(["a b/c:d=e%", "none", "é"])
    table.upsert(frame(spark, (1, "a b/c:d=e%", 9), (2, None, 9), (3, "", 9)), ["id"])
    assert rows(table.read()) == [(1, "a b/c:d=e%", 9), (2, None, 9), (3, "", 9), (4, "é", 4)]


def test_upsert_rewrites_only_touched_partitions(spark, table, rows):
    table.replace(frame(spark, (1, "a", 10), (2, "b", 20), (3, "c", 30)))
    before = table.manifest().dirs
    table.upsert(frame(spark, (2, "b", 21), (4, "d", 40)), ["id"])
    after = table.manifest().dirs
    assert after["a"] == before["a"] and after["c"] == before["c"] and after["b"] != before["b"]
    assert rows(table.read()) == [(1, "a", 10), (2, "b", 21), (3, "c", 30), (4, "d", 40)]


def test_upsert_follows_a_key_to_another_partition(spark, table, rows):
    table.replace(frame(spark, (1, "a", 10), (2, "b", 20)))
    table.upsert(frame(spark, (1, "b", 11)), ["id"])
    assert rows(table.read()) == [(1, "b", 11), (2, "b", 20)]
    assert table.partitions() == ["b"]


def test_upsert_is_idempotent(spark, table, rows):
    table.replace(frame(spark, (1, "a", 10), (2, "b", 20)))
    delta = frame(spark, (2, "b", 21), (3, "a", 30))
    table.upsert(delta, ["id"])
    once = rows(table.read())
    table.upsert(delta, ["id"])
    assert rows(table.read()) == once


def test_upsert_inserts_null_keys(spark, table, rows):
    table.replace(frame(spark, (None, "a", 10)))
    table.upsert(frame(spark, (None, "a", 11), (None, "a", 12)), ["id"])
    assert rows(table.read()) == [(None, "a", 10), (None, "a", 11), (None, "a", 12)]


def test_upsert_refuses_repeated_keys_and_leaves_the_table_alone(spark, table, rows):
    table.replace(frame(spark, (1, "a", 10)))
    with pytest.raises(ValueError, match="repeats"):
        table.upsert(frame(spark, (2, "a", 1), (2, "b", 2)), ["id"])
    assert rows(table.read()) == [(1, "a", 10)]


def test_upsert_needs_keys(spark, table):
    with pytest.raises(ValueError):
        table.upsert(frame(spark, (1, "a", 10)), [])


def test_upsert_of_nothing(spark, table, rows):
    table.replace(frame(spark, (1, "a", 10)))
    table.upsert(frame(spark), ["id"])
    assert rows(table.read()) == [(1, "a", 10)]


def test_composite_keys_without_partitions(spark, tmp_path, rows):
    plain = PublishedTable(spark, str(tmp_path / "plain"))
    plain.replace(frame(spark, (1, "a", 10), (1, "b", 20)))
    plain.upsert(frame(spark, (1, "b", 21), (2, "b", 30)), ["id", "grp"])
    assert rows(plain.read()) == [(1, "a", 10), (1, "b", 21), (2, "b", 30)]


def test_append_keeps_duplicates(spark, table, rows):
    table.append(frame(spark, (1, "a", 10)))
    table.append(frame(spark, (1, "a", 10)))
    assert rows(table.read()) == [(1, "a", 10), (1, "a", 10)]


def test_empty_table_reads_back(spark, table):
    table.replace(frame(spark))
    assert table.exists() and table.read().count() == 0


def test_other_schema_is_refused(spark, table):
    table.replace(frame(spark, (1, "a", 10)))
    with pytest.raises(ValueError, match="schema"):
        table.append(spark.createDataFrame([(1, "a")], "id bigint, grp string"))


def test_failed_job_leaves_the_old_version(spark, table, rows):
    table.replace(frame(spark, (1, "a", 10)))
    failing = table.read().withColumn("amount", F.raise_error(F.lit("lost")).cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        table.replace(failing)
    assert rows(table.read()) == [(1, "a", 10)]


def test_the_later_of_two_overlapping_runs_fails(spark, table, rows):
    table.replace(frame(spark, (1, "a", 10)))
    base = table.manifest()
    table.append(frame(spark, (2, "a", 20)))
    with pytest.raises(FileExistsError):
        table.replace_partitions(frame(spark, (3, "a", 30)), [], base)
    assert rows(table.read()) == [(1, "a", 10), (2, "a", 20)]


def test_ledger_grows_by_a_line_per_build(spark, tmp_path, table):
    ledger = str(tmp_path / "ledger")
    audited_publish(frame(spark, (1, "a", 10), (2, "b", 20)), table, ledger, "run-1")
    lines = audited_publish(frame(spark), table, ledger, "run-2", "compliance").orderBy("run_id").collect()
    assert [(r.relation_name, r.run_id, r.row_count, r.compliance_owner) for r in lines] == [
        (table.path, "run-1", 2, "unassigned"),
        (table.path, "run-2", 0, "compliance"),
    ]
    assert all(line.built_at is not None for line in lines)


def test_build_time_is_utc_in_any_session_zone(spark, tmp_path, table):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        (line,) = audited_publish(frame(spark, (1, "a", 10)), table, str(tmp_path / "ledger"), "run").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert abs(datetime.now(UTC).replace(tzinfo=None) - line.built_at) < timedelta(minutes=5)


def test_a_partition_is_written_by_one_task_when_small(spark, table):
    """Eight tasks hold rows of every partition; without rebalancing each would write three files."""
    df = spark.range(0, 8000, 1, 8).selectExpr("id", "concat('g', id % 3) AS grp", "id AS amount")
    table.replace(df)
    files = {part: [n for d in dirs for n in storage.list_names(spark, f"{table.path}/{d}") if n.endswith(".parquet")]
             for part, dirs in table.manifest().dirs.items()}
    assert {part: len(names) for part, names in files.items()} == {"g0": 1, "g1": 1, "g2": 1}


def test_backfill_mode_stores_nothing_and_gives_the_same_rows(spark, tmp_path, rows):
    raw = DriverTables(spark, "/root/testdata/sf0.001")
    stored = PublishedTable(spark, str(tmp_path / "stored"))
    planned = PublishedTable(spark, str(tmp_path / "planned"))
    a = RetailMarts(raw, Settings()).publish_orders_backfill(stored)
    b = RetailMarts(raw, Settings(run_mode="backfill")).publish_orders_backfill(planned)
    assert stored.exists() and not planned.exists()
    assert rows(a.drop("pipeline_run_mode")) == rows(b.drop("pipeline_run_mode"))
    assert {r[0] for r in b.select("pipeline_run_mode").distinct().collect()} == {"backfill"}


def test_scratch_is_under_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    first, second = storage.scratch_dir(spark), storage.scratch_dir(spark)
    assert first != second
    if shared:
        assert first.startswith(shared)


def test_tree_bytes_and_names(spark, tmp_path):
    path = str(tmp_path / uuid.uuid4().hex)
    assert storage.tree_bytes(spark, path) == 0 and storage.list_names(spark, path) == []
    storage.write_new_text(spark, f"{path}/a.json", "xyz")
    assert storage.tree_bytes(spark, path) >= 3 and "a.json" in storage.list_names(spark, path)
    assert storage.read_text(spark, f"{path}/a.json") == "xyz"
    with pytest.raises(FileExistsError):
        storage.write_new_text(spark, f"{path}/a.json", "other")


def test_csv_extract(spark, tmp_path):
    (tmp_path / "raw_guilds.csv").write_text("guild_id,guild_name,founded_year\nG-1,\"Quill, Silver\",1778\nG-2,Flask,\n")
    guilds = ExtractFolder(spark, str(tmp_path)).table("raw_guilds").collect()
    assert [tuple(g) for g in guilds] == [("G-1", "Quill, Silver", 1778), ("G-2", "Flask", None)]


def test_csv_header_must_match(spark, tmp_path):
    (tmp_path / "g.csv").write_text("guild_name,guild_id,founded_year\nA,G-1,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path / "g.csv"), SCHEMAS["raw_guilds"]).collect()


def test_ledger_tells_tables_of_one_leaf_name_apart(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    one = PublishedTable(spark, str(tmp_path / "one" / "sales"), relation="one.sales")
    two = PublishedTable(spark, str(tmp_path / "two" / "sales"), relation="two.sales")
    audited_publish(frame(spark, (1, "a", 10)), one, ledger, "run")
    names = {row.relation_name for row in audited_publish(frame(spark), two, ledger, "run").collect()}
    assert names == {"one.sales", "two.sales"} and PublishedTable(spark, ledger).manifest().version == 2


def keyed(spark, tmp_path, kind="bigint"):
    return PublishedTable(spark, str(tmp_path / "keyed"), F.col("grp"), keys=["id"])


def opened(table, monkeypatch, delta, keys=("id",)):
    """Partitions of the files that an upsert of ``delta`` searches for its keys."""
    seen, candidates = [], table._candidates
    monkeypatch.setattr(table, "_candidates", lambda *args: seen.extend(candidates(*args)) or seen)
    table.upsert(delta, list(keys))
    return sorted({entry.directory.rpartition("=")[2] for entry in seen})


def test_upsert_searches_only_where_the_keys_may_be(spark, tmp_path, monkeypatch, rows):
    table = keyed(spark, tmp_path)
    months = [(100 * month + k, f"m{month:02d}", k) for month in range(30) for k in range(5)]
    table.replace(frame(spark, *months))
    # The key 703 moves from month 7 to month 20; no other month is searched.
    assert opened(table, monkeypatch, frame(spark, (703, "m20", -1))) == ["m07"]
    expected = sorted([row for row in months if row[0] != 703] + [(703, "m20", -1)], key=repr)
    assert rows(table.read()) == expected
    assert all(entry.bounds for entry in table.manifest().entries)


def names(table, version=None):
    return {entry.name for entry in table.manifest(version).entries}


def test_only_files_that_hold_a_key_are_rewritten_where_ranges_overlap(spark, tmp_path, monkeypatch, rows):
    table = keyed(spark, tmp_path)
    spread = [(k, f"g{k % 30:02d}", 0) for k in range(300)]  # every group spans nearly all keys
    table.replace(frame(spark, *spread))
    before = names(table)
    seen = opened(table, monkeypatch, frame(spark, (155, "g00", 1)))
    assert "g05" in seen and len(before - names(table)) == 1
    assert (155, "g00", 1) in rows(table.read()) and table.read().count() == 300


def test_a_small_delta_on_many_random_keys_rewrites_only_their_files(spark, tmp_path, rows):
    """Ten keys of a million, in one partition of at least 100 files."""
    table = PublishedTable(spark, str(tmp_path / "t"), F.col("grp"), keys=["id"], file_rows=10_000)
    source = spark.range(1_000_000).selectExpr("xxhash64(id) as id", "'m' as grp", "id as amount")
    table.replace(source)
    before = names(table)
    assert len(before) >= 100
    delta = source.filter("amount % 100000 = 7").withColumn("amount", F.lit(-1).cast("bigint"))
    table.upsert(delta, ["id"])
    gone = before - names(table)
    assert 1 <= len(gone) <= 10 and table.read().count() == 1_000_000
    assert table.read().filter("amount = -1").count() == 10
    # What a manifest says of a file does not grow with the file.
    text = storage.read_text(spark, f"{table.path}/manifests/0000000002.json")
    assert len(text) < 600 * (len(names(table)) + 5)


def test_files_carry_bloom_filters_on_the_keys(spark, tmp_path):
    """Of files with one key range the filters tell which cannot hold a key: the scan reads no row of them."""
    table = PublishedTable(spark, str(tmp_path / "t"), keys=["id"])
    for k in range(4):
        table.append(spark.range(20_000).selectExpr(f"xxhash64(id * 4 + {k}) as id", "'g' as grp", "id as amount"))
    wanted = spark.range(1).selectExpr("xxhash64(bigint(4001)) as id").first()["id"]
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in names(table):
        footer = jvm.org.apache.parquet.hadoop.ParquetFileReader.readFooter(conf, jvm.org.apache.hadoop.fs.Path(f"{table.path}/{name}"))
        columns = {c.getPath().toDotString(): c.getBloomFilterOffset() for c in footer.getBlocks().get(0).getColumns()}
        assert columns["id"] > 0 and columns["amount"] <= 0
    searched = table._candidates(["id"], Bounds((wanted,), (wanted,)), [(wanted,)], table.manifest())
    assert len(searched) >= 4  # by their ranges any load may hold it
    assert len(table.files_with(spark.createDataFrame([(wanted,)], "id bigint"), ["id"], table.manifest())) == 1


# Merge on read


def test_merge_on_read_equals_copy_on_write(spark, tmp_path, rows):
    eager, lazy = (PublishedTable(spark, str(tmp_path / name), F.col("grp"), keys=["id"]) for name in ("eager", "lazy"))
    start = frame(spark, *((k, f"g{k % 3}", k) for k in range(30)), (None, "g0", 5))
    deltas = [
        frame(spark, (1, "g1", -1), (40, "g9", 40)),
        frame(spark, (1, "g2", -2), (2, "g2", -2), (None, "g1", 6)),
        frame(spark),
        frame(spark, (40, "g0", 41)),
    ]
    for table in (eager, lazy):
        table.replace(start)
    for delta in deltas:
        eager.upsert(delta, ["id"])
        lazy.upsert_on_read(delta)
        assert rows(lazy.read()) == rows(eager.read())
        assert rows(lazy.read(["g0", "g9"])) == rows(eager.read(["g0", "g9"]))
    lazy.compact(100)
    assert rows(lazy.read()) == rows(eager.read()) and lazy.manifest().deletes == []
    lazy.expire(keep=1, min_age=timedelta(0))
    assert rows(lazy.read()) == rows(eager.read()) and storage.list_names(spark, f"{lazy.path}/deletes") == []


def test_merge_on_read_writes_in_proportion_to_the_delta(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path / "t"), keys=["id"])
    table.replace(spark.range(200_000).selectExpr("id", "uuid() as grp", "id as amount"))
    before, size = names(table), storage.tree_bytes(spark, table.path)
    table.upsert_on_read(frame(spark, *((k * 997, "x", -1) for k in range(50))))
    assert before < names(table) and storage.tree_bytes(spark, table.path) - size < size / 50
    assert table.read().count() == 200_000 and table.read().filter("amount = -1").count() == 50


def test_deletes_and_rows_that_come_back(spark, tmp_path, rows):
    table = keyed(spark, tmp_path)
    table.replace(frame(spark, (1, "a", 1), (2, "b", 2), (None, "a", 3)))
    table.delete_on_read(frame(spark, (1, "zz", 0), (None, "zz", 0), (9, "zz", 0)).select("id"))
    assert rows(table.read()) == [(2, "b", 2), (None, "a", 3)]
    table.append(frame(spark, (1, "a", 10)))
    assert rows(table.read()) == [(1, "a", 10), (2, "b", 2), (None, "a", 3)]
    table.upsert(frame(spark, (2, "a", 20)), ["id"])
    assert rows(table.read()) == [(1, "a", 10), (2, "a", 20), (None, "a", 3)]
    table.delete_on_read(frame(spark, (1, "a", 0), (2, "a", 0)).select("id"))
    table.compact()
    assert rows(table.read()) == [(None, "a", 3)] and table.manifest().deletes == []
    old = table.manifest(1)
    assert rows(table.read(at=old)) == [(1, "a", 1), (2, "b", 2), (None, "a", 3)]


def test_files_beyond_the_deleted_keys_are_read_without_a_join(spark, tmp_path, capsys):
    table = keyed(spark, tmp_path)
    table.replace(frame(spark, *((k, "a" if k < 50 else "b", k) for k in range(100))))
    table.delete_on_read(frame(spark, (7, "a", 0)).select("id"))
    table.read(["b"]).explain()
    assert "Anti" not in capsys.readouterr().out
    table.read(["a"]).explain()
    assert "Anti" in capsys.readouterr().out


@pytest.mark.parametrize("step", ["write_new_text", "files_under"])
def test_a_crash_within_a_merge_leaves_the_old_version(spark, tmp_path, monkeypatch, rows, step):
    table = keyed(spark, tmp_path)
    table.replace(frame(spark, (1, "a", 1), (2, "b", 2)))
    table.upsert_on_read(frame(spark, (1, "a", 10)))
    before = rows(table.read())

    def lost(*args):
        raise ConnectionError("driver lost")

    for run in (
        lambda: table.upsert_on_read(frame(spark, (2, "b", 20))),
        lambda: table.upsert(frame(spark, (2, "b", 20)), ["id"]),
        lambda: table.compact(),
    ):
        with monkeypatch.context() as broken:
            broken.setattr(storage, step, lost)
            with pytest.raises(ConnectionError):
                run()
        assert rows(table.read()) == before
    table.expire(keep=1, min_age=timedelta(0))
    assert rows(table.read()) == before


def test_changes_between_versions(spark, tmp_path, rows):
    table = keyed(spark, tmp_path)
    table.replace(frame(spark, (1, "a", 1), (2, "a", 2), (3, "b", 3), (3, "b", 3)))
    table.upsert(frame(spark, (1, "b", 10)), ["id"])
    table.upsert_on_read(frame(spark, (2, "a", 20)))
    table.delete_on_read(frame(spark, (3, "b", 0)).select("id"))
    moved = lambda a, b: rows(table.changes(table.manifest(a), table.manifest(b)))
    assert moved(1, 2) == sorted([(1, "a", 1, -1), (1, "b", 10, 1)], key=repr)
    assert moved(2, 3) == sorted([(2, "a", 2, -1), (2, "a", 20, 1)], key=repr)
    assert moved(3, 4) == [(3, "b", 3, -1), (3, "b", 3, -1)]
    everything = [(1, "a", 1, -1), (1, "b", 10, 1), (2, "a", 2, -1), (2, "a", 20, 1), (3, "b", 3, -1), (3, "b", 3, -1)]
    assert moved(1, 4) == sorted(everything, key=repr) and moved(2, 2) == []
    table.compact(0)
    assert moved(4, 5) == []


# Audited builds


def failing(rows):
    return run_checks({"t": rows}, {"t": (NotNull("id"), AcceptedValues("grp", ("a", "b")))})


def test_a_failing_check_leaves_the_old_version_and_a_line(spark, tmp_path, table, rows):
    ledger = BuildLedger(spark, str(tmp_path / "ledger"))
    publish = lambda run, *data: audited_publish(frame(spark, *data), table, ledger.table.path, run, failures=failing)
    publish("one", (1, "a", 10))
    with pytest.raises(RejectedBuild, match="accepted_values"):
        publish("two", (2, "zz", 1), (None, "a", 1))
    assert rows(table.read()) == [(1, "a", 10)] and table.manifest().version == 1
    lines = {row.run_id: row for row in ledger.lines().collect()}
    assert lines["two"].outcome == "rejected" and lines["two"].row_count == 2
    assert lines["two"].failed_checks == "accepted_values(grp), not_null(id)"
    (kept,) = table.rejected()
    assert rows(table.read(at=kept)) == sorted([(2, "zz", 1), (None, "a", 1)], key=repr)
    assert [row.run_id for row in ledger.builds().collect()] == ["one"]
    publish("three", (3, "b", 1))
    assert rows(table.read()) == [(3, "b", 1)] and ledger.lines().count() == 3
    table.expire(keep=1, min_age=timedelta(0))
    assert table.rejected() == [] and rows(table.read()) == [(3, "b", 1)]


@pytest.mark.parametrize("crash_at", [1, 2, 3, 4])
def test_a_crash_leaves_rows_and_line_or_neither(spark, tmp_path, table, rows, monkeypatch, crash_at):
    ledger = BuildLedger(spark, str(tmp_path / "ledger"))
    audited_publish(frame(spark, (1, "a", 10)), table, ledger.table.path, "one")
    calls, real = [], storage.write_new_text

    def sometimes(session, path, text):
        """The table's manifest is the first small file of a publish, the ledger's the second."""
        calls.append(path)
        if len(calls) == (crash_at + 1) // 2:
            if crash_at % 2 == 0:
                real(session, path, text)
            raise ConnectionError("driver lost")
        real(session, path, text)

    with monkeypatch.context() as broken:
        broken.setattr(storage, "write_new_text", sometimes)
        with pytest.raises(ConnectionError):
            audited_publish(frame(spark, (2, "a", 20)), table, ledger.table.path, "two")
    published = rows(table.read()) == [(2, "a", 20)]
    assert published == (crash_at > 1)
    ledger.settle([table])
    assert ("two" in [row.run_id for row in ledger.builds().collect()]) == published
    audited_publish(frame(spark, (3, "a", 30)), table, ledger.table.path, "three")
    runs = sorted(row.run_id for row in ledger.builds().collect())
    assert runs == ["one", "three", "two"] if published else runs == ["one", "three"]


def test_expire_spares_a_write_that_still_adds_files(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path / "t"))
    table.replace(frame(spark, (1, "a", 1)))
    running = f"{tmp_path}/t/data/running"
    frame(spark, (2, "b", 2)).write.parquet(running)
    old = (datetime.now() - timedelta(days=3)).timestamp()
    parts = [name for name in os.listdir(running) if name.endswith(".parquet")]
    for name in [*os.listdir(running), "."]:
        os.utime(os.path.join(running, name), (old, old))
    os.utime(os.path.join(running, parts[0]))  # a file finished just now, below a folder made days ago
    table.expire(min_age=timedelta(days=1))
    assert "running" in storage.list_names(spark, f"{table.path}/data")
    for name in [*os.listdir(running), "."]:
        os.utime(os.path.join(running, name), (old, old))
    table.expire(min_age=timedelta(days=1))
    assert "running" not in storage.list_names(spark, f"{table.path}/data")


def test_other_keys_null_keys_and_older_manifests_are_searched_in_full(spark, tmp_path, monkeypatch, rows):
    table = keyed(spark, tmp_path)
    table.replace(frame(spark, (1, "a", 10), (2, "b", 20)))
    assert sorted(opened(table, monkeypatch, frame(spark, (9, "c", 10)), ["amount"])) == ["a", "b"]
    assert rows(table.read()) == [(2, "b", 20), (9, "c", 10)]
    table.upsert(frame(spark, (None, "b", 1)), ["id"])
    assert rows(table.read()) == [(2, "b", 20), (9, "c", 10), (None, "b", 1)]


def test_expire_keeps_what_live_manifests_name(spark, tmp_path, rows):
    table = PublishedTable(spark, str(tmp_path / "t"), F.col("grp"), keys=["id"])
    for k in range(4):
        table.upsert(frame(spark, (1, "a", k), (10 + k, f"p{k}", k)), ["id"])
    reader = table.read()
    table.expire(keep=1)  # too young to go
    assert len(storage.list_names(spark, f"{table.path}/manifests")) == 4
    table.expire(keep=1, min_age=timedelta(0))
    assert len(storage.list_names(spark, f"{table.path}/manifests")) == 1
    assert rows(reader) == rows(table.read()) == [(1, "a", 3), *((10 + k, f"p{k}", k) for k in range(4))]
    live = {name.split("/")[1] for name in table.manifest().all_dirs}
    assert set(storage.list_names(spark, f"{table.path}/data")) == live
    table.expire(keep=1, min_age=timedelta(0))
    assert table.read().count() == 5
    with pytest.raises(ValueError):
        table.expire(keep=0)


def test_expire_removes_what_a_crash_left(spark, tmp_path, rows):
    table = PublishedTable(spark, str(tmp_path / "t"))
    table.replace(frame(spark, (1, "a", 1)))
    frame(spark, (2, "b", 2)).write.parquet(f"{table.path}/data/orphan")
    table.expire(min_age=timedelta(0))
    assert "orphan" not in storage.list_names(spark, f"{table.path}/data") and rows(table.read()) == [(1, "a", 1)]


def test_compaction(spark, table, rows):
    for k in range(5):
        table.append(frame(spark, (k, "a", k), (k, "b" if k else "c", k)))
    before = rows(table.read())
    table.compact(most_dirs=4)
    dirs = table.manifest().dirs
    assert [len(dirs[part]) for part in ("a", "b", "c")] == [1, 4, 1] and rows(table.read()) == before


def test_scratch_of_an_upsert_is_removed(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path / "t"))
    seen = []
    with storage.scratch_space(spark) as keep:
        seen.append(keep(frame(spark, (1, "a", 1))).inputFiles()[0])
    assert not os.path.exists(seen[0].removeprefix("file://"))
    table.upsert(frame(spark, (1, "a", 1)), ["id"])
    assert table.read().count() == 1
