from __future__ import annotations

import math

import numpy as np
import pytest

from tallyforge.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, vector string, whitened string, deviation string"


def frame(spark, vectors):
    rows = [(k, None if v is None else [None if x is None else float(x) for x in v], "x", "x", "x") for k, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def expected(vectors, components=4):
    """By numpy on the distinct whole-number vectors: per vector the exact deviation and whitened values."""
    x = [[math.floor(256 * c) for c in v] for v in vectors]
    listed = np.array(sorted(set(map(tuple, x))), object)
    n, sums = len(listed), listed.sum(axis=0)
    centred = (listed - np.array([s / n for s in sums])).astype(float)
    covariance = centred.T @ centred / n
    values, basis = np.linalg.eigh(covariance)
    order = np.argsort(-values)[:components]
    turned = (np.array(x, float) - np.array([s / n for s in sums])) @ basis[:, order] / np.sqrt(values[order])
    deviations = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    return n, deviations, turned, values[order] / np.trace(covariance)


def test_report_equals_numpy(spark):
    rng = np.random.default_rng(3)
    good = rng.normal(size=(300, 12)) @ np.diag(np.linspace(3, 0.5, 12)) + 5
    good = np.concatenate([good, good[:40], good[:1].repeat(100, axis=0)])
    bad = [None, [], [None] * 12, [math.inf] * 12, [math.nan] + [0.0] * 11, [1.0] * 11, [1e300] * 12]
    df = frame(spark, [*good, *bad])
    got = whitening.whitening_report(df).collect()
    n, deviations, turned, shares = expected(good)
    assert len(got) == 4 * len(good) and {row.n for row in got} == {n}
    signs = {}
    for row in got:
        k, c = row.vec_id, row.component - 1
        assert row.deviation == deviations[k] and row.explained == pytest.approx(shares[c])
        assert row.identity_error < 1e-9 and abs(row.whitened) == pytest.approx(abs(turned[k, c]), abs=1e-9)
        if abs(turned[k, c]) > 1e-6:
            signs.setdefault(c, set()).add(row.whitened * turned[k, c] > 0)
    assert all(len(found) == 1 for found in signs.values())


def test_general_form_keeps_other_columns(spark):
    df = frame(spark, np.random.default_rng(1).normal(size=(30, 6)).tolist() + [None])
    fit = whitening.fit_whitening(df, "embedding", 3)
    out = whitening.whiten(df, "embedding", fit)
    assert out.columns == ["vec_id", "vector", "whitened", "deviation"] and out.count() == 30
    assert all(len(row.whitened) == 3 for row in out.collect())


@pytest.mark.parametrize("vectors", [[], [None, None], [[], []], [[None, 1.0]], [[math.nan]]])
def test_nothing_usable(spark, vectors):
    assert whitening.whitening_report(frame(spark, vectors)).isEmpty()


def test_no_variation(spark):
    rows = whitening.whitening_report(frame(spark, [[1.0, 2.0]] * 5)).collect()
    assert len(rows) == 10 and all(row.whitened is row.explained is row.identity_error is None for row in rows)
    assert {row.deviation for row in rows} == {0} and {row.n for row in rows} == {1}
    line = whitening.whitening_report(frame(spark, [[float(k), 1.0] for k in range(9)])).collect()
    assert all((row.whitened is None) == (row.component == 2) for row in line)
    assert {row.identity_error < 1e-12 for row in line} == {True}


def test_numbers_beyond_64_bits(spark):
    big = [[2.0**50, 0.0], [-(2.0**50), 1.0], [2.0**50, 0.0], [0.0, 3.0]]
    rows = whitening.whitening_report(frame(spark, big)).collect()
    exact = {d if d < 2**63 else None for d in expected(big, 2)[1]}
    assert {row.deviation for row in rows} == exact and None in exact
    fine = [[2.0**20, 0.0], [0.0, 1.0]]
    n, deviations, _, _ = expected(fine, 2)
    assert {row.deviation for row in whitening.whitening_report(frame(spark, fine)).collect()} == set(deviations)


@pytest.mark.parametrize("kind", ["spread", "clusters", "repeated", "diagonal", "low rank"])
def test_components_equal_an_eigensolver(kind):
    rng = np.random.default_rng(len(kind))
    basis = np.linalg.qr(rng.normal(size=(20, 20)))[0]
    values = {
        "spread": np.logspace(0, -12, 20),
        "clusters": np.concatenate([1 + 1e-5 * np.arange(10), 5 + 1e-5 * np.arange(10)]),
        "repeated": np.repeat([3.0, 2.0, 1.0, 0.5], 5),
        "diagonal": np.arange(20.0),
        "low rank": np.concatenate([np.zeros(15), np.arange(1.0, 6)]),
    }[kind]
    matrix = basis @ np.diag(values) @ basis.T if kind != "diagonal" else np.diag(values)
    matrix = (matrix + matrix.T) / 2
    found, vectors = whitening.leading_components(matrix, 6)
    assert np.allclose(found, np.sort(values)[::-1][:6], rtol=0, atol=1e-13 * values.max())
    assert np.allclose(vectors.T @ vectors, np.eye(6), atol=1e-12)
    assert np.allclose(matrix @ vectors, vectors * found, atol=1e-12 * values.max())


def test_polar_factor():
    matrix = np.random.default_rng(0).normal(size=(9, 9))
    matrix = matrix + matrix.T
    sign = whitening.polar_factor(matrix)
    values, basis = np.linalg.eigh(matrix)
    assert np.allclose(sign, basis @ np.diag(np.sign(values)) @ basis.T, atol=1e-12)


def test_packing_is_an_exact_round_trip():
    import pyarrow as pa

    rows = np.array([[1, -2, 3], [70_000, 0, -1], [1 << 40, -5, 0], [-32_768, 32_767, 0], [0, 0, 32_768]])
    assert sorted(map(tuple, whitening.unpack(pa.array(whitening.pack(rows)), 3))) == sorted(map(tuple, rows))
