from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyforge.operators.checks import duplicate_audit
from tallyforge.sources.published import PublishedTable, month_partition
from tallyforge.plans import staging
from tallyforge.settings import Settings
from tallyforge.streaming.incremental import high_water_mark, load, load_keyless, newer_rows, possibly_newer

SCHEMA = "payment_id bigint, amount bigint, paid_at timestamp_ntz"
JAN, FEB, MAR = datetime(2024, 1, 10), datetime(2024, 2, 10, 12), datetime(2024, 3, 1)


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


@pytest.fixture(params=["monthly", "whole", "other"])
def table(spark, tmp_path, request):
    if request.param == "whole":
        return PublishedTable(spark, str(tmp_path / "payments"))
    partition = month_partition("paid_at") if request.param == "monthly" else F.col("amount") % 3
    ordered_by = "paid_at" if request.param == "monthly" else None
    return PublishedTable(spark, str(tmp_path / "payments"), partition, ["payment_id"], ordered_by)


def run(table, source, **options):
    load(table, source, "paid_at", ["payment_id"], **options)


def mark_of(table):
    return high_water_mark(table, "paid_at")


def test_first_run_loads_everything_also_rows_without_a_time(spark, table, rows):
    run(table, frame(spark, (1, 10, JAN), (2, 20, None)))
    assert rows(table.read(), "payment_id") == [(1,), (2,)]
    assert mark_of(table) == JAN


def test_boundary_is_read_again_and_older_rows_are_not(spark, table, rows):
    run(table, frame(spark, (1, 10, JAN), (2, 20, FEB)))
    late = datetime(2024, 2, 10, 11)
    run(table, frame(spark, (2, 21, FEB), (3, 30, FEB), (4, 40, late), (5, 50, MAR), (6, 60, None)))
    assert rows(table.read(), "payment_id", "amount") == [(1, 10), (2, 21), (3, 30), (5, 50)]


def test_lookback_catches_late_rows(spark, table, rows):
    run(table, frame(spark, (2, 20, FEB)))
    source = frame(spark, (2, 20, FEB), (4, 40, FEB - timedelta(hours=1)), (5, 50, FEB - timedelta(days=3)))
    run(table, source, lookback=timedelta(days=1))
    assert rows(table.read(), "payment_id") == [(2,), (4,)]


def test_empty_target_is_loaded_in_full(spark, table, rows):
    run(table, frame(spark))
    assert mark_of(table) is None
    run(table, frame(spark, (1, 10, JAN), (2, 20, None)))
    assert rows(table.read(), "payment_id") == [(1,), (2,)]


def test_target_without_any_time_is_loaded_in_full(spark, table, rows):
    run(table, frame(spark, (1, 10, None)))
    run(table, frame(spark, (1, 11, None), (2, 20, JAN)))
    assert rows(table.read(), "payment_id", "amount") == [(1, 11), (2, 20)]


def test_repeated_runs_change_nothing(spark, table, rows):
    source = frame(spark, (1, 10, JAN), (2, 20, FEB), (3, 30, FEB))
    for _ in range(3):
        run(table, source)
        assert rows(duplicate_audit(table.read(), "payment_id")) == [(3, 3, 0)]


def test_keyless_runs_duplicate_the_boundary_every_time(spark, table, rows):
    source = frame(spark, (1, 10, JAN), (2, 20, FEB), (3, 30, FEB))
    audits = []
    for _ in range(3):
        load_keyless(table, source, "paid_at")
        audits += rows(duplicate_audit(table.read(), "payment_id"))
    assert audits == [(3, 3, 0), (5, 3, 2), (7, 3, 4)]


def test_full_refresh_clears_duplicates(spark, table, rows):
    source = frame(spark, (1, 10, JAN), (2, 20, FEB))
    load_keyless(table, source, "paid_at")
    load_keyless(table, source, "paid_at")
    run(table, source, full_refresh=True)
    assert rows(duplicate_audit(table.read(), "payment_id")) == [(2, 2, 0)]


def test_repeated_key_in_the_delta_is_an_error(spark, table):
    run(table, frame(spark, (1, 10, JAN)))
    with pytest.raises(ValueError, match="repeats"):
        run(table, frame(spark, (2, 20, FEB), (2, 21, FEB)))


def test_keys_are_required(spark, table):
    with pytest.raises(ValueError):
        load(table, frame(spark), "paid_at", [])
    with pytest.raises(TypeError):
        load(table, frame(spark), "paid_at", unique_keys=["payment_id"])


def test_window_filter_reaches_the_scan(spark, tmp_path, capsys):
    path = str(tmp_path / "source")
    frame(spark, (1, 10, JAN), (2, 20, FEB)).write.parquet(path)
    newer_rows(spark.read.parquet(path), "paid_at", FEB).explain()
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(paid_at" in plan


def test_mark_reads_only_the_newest_month(spark, tmp_path, monkeypatch):
    table = PublishedTable(spark, str(tmp_path / "p"), month_partition("paid_at"), ordered_by="paid_at")
    table.replace(frame(spark, (1, 10, JAN), (2, 20, FEB), (3, 30, None)))
    read, asked = table.read, []
    monkeypatch.setattr(table, "read", lambda parts=None, at=None: asked.append(parts) or read(parts, at))
    assert high_water_mark(table, "paid_at") == FEB and asked == [["2024-02"]]


def test_microseconds_survive_the_mark(spark, table, rows):
    at = datetime(2024, 1, 1, 0, 0, 7, 179575)
    run(table, frame(spark, (1, 10, at)))
    source = frame(spark, (1, 11, at), (2, 20, at - timedelta(microseconds=1)))
    got = newer_rows(source, "paid_at", mark_of(table))
    assert rows(got.select("payment_id")) == [(1,)]


def test_mark_of_a_partition_that_is_not_time(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path / "p"), F.col("amount") % 2)
    table.replace(frame(spark, (1, 10, MAR), (2, 11, JAN)))
    assert mark_of(table) == MAR
    load_keyless(table, frame(spark, (1, 10, MAR), (2, 11, JAN)), "paid_at")
    assert table.read().count() == 3


def test_text_times_are_filtered_in_the_scan_and_exactly_after(spark, tmp_path, capsys):
    texts = [
        "2024-02-10T12:00:00Z",
        "2024-02-10 12:00:01",
        "  2024-02-11 00:00:00",
        "\t2024-02-12T00:00:00Z",
        "2024-02-10",
        "2024-02-09 23:59:59",
        " 2023-01-01 00:00:00",
        "n/a",
        "",
        None,
    ]
    path = str(tmp_path / "raw")
    data = [(k, 1, "coin", "success", 5, text) for k, text in enumerate(texts)]
    names = "payment_id bigint, order_id bigint, method string, status string, amount_copper bigint, paid_at string"
    spark.createDataFrame(data, names).write.parquet(path)
    raw = spark.read.parquet(path)
    window = possibly_newer(raw, "paid_at", FEB)
    window.explain()
    assert "GreaterThanOrEqual(paid_at,2024-02-10)" in capsys.readouterr().out
    got = newer_rows(staging.payments(window, Settings()), "paid_at", FEB)
    exact = newer_rows(staging.payments(raw, Settings()), "paid_at", FEB)
    ids = sorted(row.payment_id for row in got.select("payment_id").collect())
    assert ids == sorted(row.payment_id for row in exact.select("payment_id").collect()) and {0, 1, 2} <= set(ids)
    assert sorted(row.payment_id for row in window.collect()) == [0, 1, 2, 3, 4, 6, 7, 8]
