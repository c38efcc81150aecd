from __future__ import annotations

from datetime import datetime

import pytest

from tallyforge.plans.build import LEDGER, build, check_build
from tallyforge.plans.marts import RetailMarts
from tallyforge.plans.quality import CHECKS
from tallyforge.settings import Settings
from tallyforge.sources.driver_tables import DriverTables
from tallyforge.sources.published import PublishedTable

AT, LATER = datetime(2024, 1, 1), datetime(2024, 2, 1)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("marts"))
    marts = RetailMarts(DriverTables(spark, "/root/testdata/sf0.001"), Settings(run_id="first"))
    return marts, root, build(marts, root, AT, shelved=True)


def test_published_tables_equal_their_models(built, rows):
    marts, _, tables = built
    models = {
        "fct_orders": marts.fct_orders(),
        "fct_order_items": marts.fct_order_items(),
        "dim_customers": marts.dim_customers(),
        "dim_potions": marts.dim_potions(),
        "fct_orders_backfill": marts.orders_backfill(),
        "agg_revenue_by_region": marts.revenue_by_region(),
        "agg_category_revenue_pivot": marts.category_revenue_pivot(),
        "agg_payment_method_mix": marts.payment_method_mix(),
        "fct_regulated_sales": marts.regulated_sales(),
        "fct_payment_events": marts.stg_payments(),
        "agg_shop_channel_mix": marts.channel_mix(),
        "dim_supplier_scorecard": marts.supplier_scorecard(),
        "fct_brew_yield": marts.brew_yield(),
    }
    assert tables.keys() == models.keys() | {"membership_history"}
    for name, model in models.items():
        assert rows(tables[name].read(), *model.columns) == rows(model), name


def test_audit_columns_are_on_the_marts_that_carry_them(built):
    _, _, tables = built
    stamped = {name for name, table in tables.items() if table.read().columns[-2:] == ["loaded_at", "run_id"]}
    assert stamped == {"fct_orders", "dim_customers", "dim_potions", "agg_revenue_by_region"}


def test_checks_on_published_tables(built, rows):
    marts, _, tables = built
    got = rows(check_build(marts, tables))
    assert len(got) == sum(map(len, CHECKS.values())) and got == rows(marts.check_all())


def test_second_build_replaces_loads_and_keeps_history(built, spark, rows):
    marts, root, tables = built
    before = {name: rows(tables[name].read()) for name in ("fct_payment_events", "membership_history", "fct_brew_yield")}
    again = build(RetailMarts(marts.raw, Settings(run_id="second")), root, LATER)
    assert {row.run_id for row in again["fct_orders"].read().collect()} == {"second"}
    for name, stored in before.items():
        assert rows(tables[name].read()) == stored, name
    lines = PublishedTable(spark, f"{root}/{LEDGER}").read().orderBy("built_at").collect()
    assert [line.run_id for line in lines] == ["first", "second"]


def test_backfill_mode_leaves_no_slim_fact(built, tmp_path, rows):
    marts, _, tables = built
    planned = build(RetailMarts(marts.raw, Settings(run_mode="backfill")), str(tmp_path), AT)
    assert "fct_orders_backfill" not in planned
    columns = [c for c in tables["agg_revenue_by_region"].read().columns if c not in ("loaded_at", "run_id")]
    revenue = "agg_revenue_by_region"
    assert rows(planned[revenue].read(), *columns) == rows(tables[revenue].read(), *columns)


def test_recipes_are_checked_by_tasks_of_their_own(built, rows, monkeypatch, capsys):
    marts, _, tables = built
    before = rows(check_build(marts, tables))
    monkeypatch.setattr(marts, "check_tasks", lambda: {"stg_potion_ingredients": 3})
    checks = check_build(marts, tables)
    capsys.readouterr()
    checks.explain()
    assert "REPARTITION_BY_NUM" in capsys.readouterr().out and rows(checks) == before


def test_marts_are_published_side_by_side(spark):
    """Each chain waits for the others to begin; one's error is raised when all have ended."""
    from threading import Barrier

    from tallyforge.plans.build import _side_by_side
    from tallyforge.sources import storage

    begun, ended = Barrier(3, timeout=60), []

    def chain(name, error=None):
        def run():
            begun.wait()
            if error:
                raise error
            assert storage.scratch_dir(spark).startswith("/owned/")
            ended.append((name, spark.range(5).count()))

        return run

    owner = storage._OWNER.set("/owned")
    try:
        with pytest.raises(ValueError, match="second"):
            _side_by_side(spark, chain("first"), chain("second", ValueError("second")), chain("third"))
    finally:
        storage._OWNER.reset(owner)
    assert sorted(ended) == [("first", 5), ("third", 5)]
