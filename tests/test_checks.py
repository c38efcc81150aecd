from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyforge.operators.checks import (
    AcceptedValues,
    NotNull,
    Relationship,
    Unique,
    duplicate_audit,
    orphans,
    require_unique,
    run_checks,
    unlisted_values,
)
from tallyforge.plans.quality import CHECKS


@pytest.fixture(scope="module")
def tables(spark):
    child = [(1, "a", 1), (2, "a", 1), (2, "b", 9), (None, None, None), (None, "x", 9)]
    return {
        "child": spark.createDataFrame(child, "id bigint, kind string, parent bigint"),
        "clean": spark.createDataFrame([(1, "a", 1), (2, None, None)], "id bigint, kind string, parent bigint"),
        "parent": spark.createDataFrame([(1,), (2,)], "pid bigint"),
    }


@pytest.mark.parametrize(
    ("check", "failing", "passing"),
    [
        (NotNull("id"), 2, 0),
        (AcceptedValues("kind", ("a", "b")), 1, 0),
        (Unique(("id",)), 1, 0),
        (Unique(("id", "kind")), 0, 0),
        (Relationship("parent", "parent", "pid"), 2, 0),
    ],
)
def test_each_check_on_a_failing_and_a_passing_table(tables, rows, check, failing, passing):
    got = rows(run_checks(tables, {"child": [check], "clean": [check]}), "table_name", "failures")
    assert got == [("child", failing), ("clean", passing)]


def test_null_counts_in_a_combination_but_not_in_a_single_key(spark, rows):
    df = spark.createDataFrame([(None, 1), (None, 1)], "a bigint, b bigint")
    checks = [Unique(("a",)), Unique(("a", "b")), Unique(("b",))]
    got = rows(run_checks({"t": df}, {"t": checks}), "column_name", "failures")
    assert got == [("a", 0), ("a,b", 1), ("b", 1)]


def test_checks_on_an_empty_table(spark, rows):
    df = spark.createDataFrame([], "id bigint")
    got = rows(run_checks({"t": df, "p": df}, {"t": [NotNull("id"), Unique(("id",)), Relationship("id", "p", "id")]}))
    assert {line[3] for line in got} == {0} and len(got) == 3


def test_checks_of_a_table_share_one_scan(spark, tmp_path, capsys):
    path = str(tmp_path / "t")
    spark.range(5).selectExpr("id", "id as b", "id as unused").write.parquet(path)
    checks = [Unique(("id",)), NotNull("id"), NotNull("b")]
    run_checks({"t": spark.read.parquet(path)}, {"t": checks}).explain("formatted")
    plan = capsys.readouterr().out
    assert plan.count("Scan parquet") == 2  # once in the tree, once in its details
    assert "unused" not in plan


def test_several_uniqueness_checks_with_row_checks(tables, rows):
    checks = [Unique(("id",)), NotNull("kind"), Unique(("kind",)), AcceptedValues("kind", ("a",)), Unique(("id", "kind"))]
    got = rows(run_checks(tables, {"child": checks}), "check_name", "column_name", "failures")
    assert got == [("accepted_values", "kind", 2), ("not_null", "kind", 1), ("unique", "id", 1), ("unique", "kind", 1),
                   ("unique_combination", "id,kind", 0)]


def test_orphans_shuffle_counted_keys(tables, rows):
    assert rows(orphans(tables["child"], "parent", tables["parent"], "pid")) == [(9, 2)]


def test_duplicate_audit(tables, rows):
    assert rows(duplicate_audit(tables["child"], "id")) == [(5, 2, 3)]


def test_unlisted_values(tables, rows):
    assert rows(unlisted_values(tables["child"], "kind", ["a"])) == [("b", 1), ("x", 1)]


def test_require_unique(tables):
    require_unique(tables["clean"], ["id"])
    require_unique(tables["child"], ["id", "kind"])
    with pytest.raises(ValueError, match="repeats"):
        require_unique(tables["child"], ["id"])


def test_declared_checks_by_kind():
    kinds = [check.name for checks in CHECKS.values() for check in checks]
    counted = {kind: kinds.count(kind) for kind in set(kinds)}
    assert counted == {"unique": 15, "not_null": 33, "accepted_values": 8, "relationships": 2, "unique_combination": 1}


def test_keys_of_a_grouped_table_are_counted_by_tasks_of_their_own(spark, rows, capsys):
    lines = spark.createDataFrame([(k % 7, k % 3, k % 5 or None) for k in range(60)], "a bigint, b bigint, c bigint")
    pairs = lines.groupBy("a", "b").agg({"c": "max"}).withColumnRenamed("max(c)", "c")
    repeated = pairs.unionByName(pairs.filter("a < 3")).unionByName(pairs.filter("a = 1").selectExpr("CAST(NULL AS bigint) a", "b", "c"))
    checks = {"pairs": [Unique(("a", "b")), NotNull("a")]}
    for df, failing in ((pairs, [0, 0]), (repeated, [9, 3])):
        dealt = run_checks({"pairs": df}, checks, {"pairs": 5})
        assert rows(dealt) == rows(run_checks({"pairs": df}, checks))
        assert [row.failures for row in dealt.orderBy(F.desc("check_name")).collect()] == failing
    capsys.readouterr()
    run_checks({"pairs": pairs}, checks, {"pairs": 5}).explain()
    plan = capsys.readouterr().out
    # One exchange makes the pairs, another deals them to the tasks that count.
    assert plan.count("hashpartitioning(a") == 2 and "REPARTITION_BY_NUM" in plan


def test_tasks_of_the_recipe_check_grow_with_the_lines(spark, monkeypatch):
    from tallyforge.plans.marts import CHECK_BYTES, RetailMarts
    from tallyforge.sources.driver_tables import DriverTables

    marts = RetailMarts(DriverTables(spark, "/root/testdata/sf0.001"))
    assert marts.check_tasks() == {"stg_potion_ingredients": 1}
    monkeypatch.setattr(marts, "_bytes", lambda table: 10 * CHECK_BYTES)
    assert marts.check_tasks() == {"stg_potion_ingredients": 10}
