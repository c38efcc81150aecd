from __future__ import annotations

import pathlib

import pytest

import __spark_entry__ as registered
import corpus_pipeline
import fixtures
import oracle_compare
from tallyforge.llm import quality, queries
from tallyforge.sources import storage

SF_DIR = "/root/testdata/sf0.001"
DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def test_every_operator_is_registered():
    names = [name for name in registered.queries() if name.startswith("op")]
    assert sorted(int(name[2:].split("_")[0]) for name in names) == list(range(1, 14))
    assert "pipeline" in registered.queries() and queries.ORACLES.keys() <= queries.QUERIES.keys()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    assert oracle_compare.differences(df, oracle_compare.connect(SF_DIR), queries.ORACLES[name]) == []


def test_queries_over_the_driver_tables(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    benchmark = [tuple(row) for row in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    texts = {row.doc_id: row.text for row in docs}
    run = lambda name: {row.doc_id: row for row in queries.QUERIES[name](spark, SF_DIR).collect()}
    found = run("op3_hyperminhash")
    expected = fixtures.near_components(list(texts.items()), 2, 80)
    assert {key: row.component_id for key, row in found.items()} == expected
    found = run("op5_wu_manber")
    assert all(tuple(row)[1:] == fixtures.contamination(texts[key], benchmark) for key, row in found.items())
    found = run("op9_run_length_index")
    expected = dict(zip(texts, fixtures.removed(list(texts.values()), 200)))
    assert {key: tuple(row)[1:] for key, row in found.items()} == expected


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert len(corpus_pipeline.STAGES) == 5
    benchmark = [tuple(row) for row in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        docs = fixtures.scanned(spark, stage(spark, docs, SF_DIR))
        after = docs.collect()
        if number < 4:
            assert docs.columns == DOCUMENT
        if number == 0:
            good = {row.doc_id for row in before if quality.first_rejection(quality.Document(row.text), quality.RULES) is None}
            assert sorted(row.doc_id for row in after) == sorted(good)
        if number == 1:
            groups = fixtures.near_components([(row.doc_id, row.text) for row in before], 5, 80)
            assert sorted(row.doc_id for row in after) == sorted(set(groups.values()))
        if number == 2:
            clean = [row.doc_id for row in before if not fixtures.contamination(row.text, benchmark)[4]]
            assert sorted(row.doc_id for row in after) == sorted(clean)
        if number == 3:
            assert {row.doc_id for row in after} <= {row.doc_id for row in before} and len(after) > len(before)
        if number == 4:
            assert sorted(row.doc_id for row in after) == sorted(row.doc_id for row in before)
            assert {row.shard for row in after} == set(range(8))


@pytest.mark.parametrize("number", range(5))
def test_stages_accept_awkward_and_empty_tables(spark, number):
    _, stage = corpus_pipeline.STAGES[number]
    for rows in ([], fixtures.awkward_rows()):
        docs = fixtures.scanned(spark, fixtures.awkward(spark, rows))
        out = stage(spark, docs, SF_DIR)
        assert set(out.columns) == set(docs.columns)
        assert out.count() > 0 if rows else out.isEmpty()


def test_scratch_holds_one_copy_of_the_documents_after_a_run(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage.tempfile, "mkdtemp", lambda prefix: str(tmp_path))
    root = pathlib.Path(storage.scratch_dir(spark).removeprefix("file:")).parent
    before = set(root.iterdir())
    rows = corpus_pipeline.run(spark, SF_DIR).count()
    made = set(root.iterdir()) - before
    copies = [path for path in made if "text" in spark.read.parquet(str(path)).columns]
    assert rows > 0 and len(copies) == 1


@pytest.mark.parametrize("number", [3, 4])
def test_documents_are_not_written_again(spark, number, monkeypatch):
    """Mixing and sharding find whole documents by where they lie; scratch holds narrow rows only."""
    from tallyforge.llm import mixing, rows, sharding

    written, real = [], rows.materialize
    for module in (mixing, rows, sharding):
        monkeypatch.setattr(module, "materialize", lambda df: written.extend(df.dtypes) or real(df))
    table = [(k, fixtures.prose(k, 30), None, "ab"[k % 2], None) for k in range(60)]
    docs = fixtures.scanned(spark, fixtures.awkward(spark, table))
    assert corpus_pipeline.STAGES[number][1](spark, docs, SF_DIR).count() >= 60
    assert written and not any(name in ("text", "row") for name, _ in written)
    # A table that is no plain scan is written once.
    assert corpus_pipeline.STAGES[number][1](spark, docs.withColumn("lang", docs.lang), SF_DIR).count() >= 60
    assert [name for name, _ in written].count("text") <= 1


@pytest.mark.parametrize("number", [3, 4])
def test_stages_do_not_depend_on_how_files_are_cut(spark, number):
    """Files are cut otherwise once the stage has run its first scan, as when an executor is lost."""
    rows = [(k, fixtures.prose(k, 5 + k % 60), None, "ab"[k % 2], None) for k in range(600)]
    docs = fixtures.scanned(spark, fixtures.awkward(spark, rows).repartition(12))
    _, stage = corpus_pipeline.STAGES[number]
    expected = sorted(row.doc_id for row in stage(spark, docs, SF_DIR).collect())
    settings = {"spark.sql.files.minPartitionNum": "1", "spark.sql.files.openCostInBytes": "1"}
    out = stage(spark, docs, SF_DIR)
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        got = out.collect()
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert sorted(row.doc_id for row in got) == expected
    assert all(row.text == rows[row.doc_id][1] for row in got)
    if number == 4:
        assert len({(row.shard, row.slot) for row in got}) == len(rows)
        assert {row.doc_id for row in got} == set(range(600))
