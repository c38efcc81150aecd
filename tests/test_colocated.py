from __future__ import annotations

import pytest

from tallyforge.plans.marts import RetailMarts
from tallyforge.settings import Settings
from tallyforge.sources.colocated import BUCKET_BYTES, ColocatedTables, buckets_for
from tallyforge.sources.driver_tables import DriverTables


@pytest.fixture
def marts(spark):
    return RetailMarts(DriverTables(spark, "/root/testdata/sf0.001"), Settings(run_id="r"))


def plan_of(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_the_order_fact_moves_no_rows(spark, marts, tmp_path, rows, capsys):
    tables = ColocatedTables(spark, "grain", "order_id", 8, str(tmp_path))
    marts.publish_order_grain(tables)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders = marts.fct_orders_colocated(tables)
        plan = plan_of(orders, capsys)
        assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan
        assert rows(orders) == rows(marts.fct_orders())
        lines = marts.fct_order_items_colocated(tables)
        plan = plan_of(lines, capsys)
        # Potions are broadcast by their size; the join on the order needs no exchange.
        assert "SortMergeJoin" in plan and "hashpartitioning" not in plan
        assert rows(lines) == rows(marts.fct_order_items())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_one_file_per_bucket_and_former_versions(spark, tmp_path, rows):
    tables = ColocatedTables(spark, "versions", "id", 4, str(tmp_path))
    tables.publish("t", spark.range(100, numPartitions=7))
    before = tables.read("t")
    assert len(before.inputFiles()) == 4
    tables.publish("t", spark.range(5))
    assert rows(tables.read("t")) == [(k,) for k in range(5)] and before.count() == 100
    assert len(tables.versions("t")) == 2
    tables.expire("t")
    assert len(tables.versions("t")) == 1 and tables.read("t").count() == 5


def test_bucket_numbers():
    assert buckets_for(0) == 8 and buckets_for(9 * BUCKET_BYTES) == 16 and buckets_for(1000 * BUCKET_BYTES) == 1024


def test_buckets_grow_with_the_tables(spark, marts, monkeypatch):
    """Lines of 645 MB and six times that: a bucket, which one task sorts, stays as it is."""
    assert marts.order_grain_buckets() == 8
    per_bucket = []
    for size in (645 << 20, 6 * 645 << 20):
        monkeypatch.setattr(marts, "_bytes", lambda table: size if table == "raw_order_items" else 0)
        per_bucket.append(size / marts.order_grain_buckets())
    assert max(per_bucket) <= 32 << 20


def test_buckets_where_sizes_are_unknown(marts, monkeypatch):
    from tallyforge.plans import marts as assembly

    monkeypatch.setattr(marts, "_bytes", lambda table: float("inf"))
    monkeypatch.setattr(assembly, "ROW_BYTES", 9 * BUCKET_BYTES // marts.raw.table("raw_order_items").count() + 1)
    assert marts.order_grain_buckets() == 16
