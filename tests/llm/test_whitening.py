"""Whitening against numpy's eigenvectors and whole-number arithmetic."""

from __future__ import annotations

import math

import numpy as np
import pytest

from millrace.llm.queries import QUERIES
from millrace.llm.whitening import _deviations, leading_eigenpairs, whiten_embeddings

SCHEMA = "vec_id long, embedding array<double>, x string, length string, data string, at string, c0 string, vid string"


def frame(spark, rows):
    df = spark.createDataFrame([(i, v, "x", "l", "d", "a", "c", "v") for i, v in rows], SCHEMA)
    return df.repartition(3) if rows else df


def expected(vectors):
    """x, n, exact deviations, eigenvalues and eigenvectors of the distinct x, and the trace."""
    x = [[math.floor(256 * c) for c in v] for v in vectors]
    fit = sorted(set(map(tuple, x)))
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    centred = np.array(fit, dtype=float) - np.array([s / n for s in sums])
    cov = centred.T @ centred / n
    values, base = np.linalg.eigh(cov)
    return np.array(x) - np.array([s / n for s in sums]), n, deviation, values[::-1], base[:, ::-1], np.trace(cov)


def check(rows, found, components=4, rel=1e-9):
    apart, n, deviation, values, base, trace = expected([v for _, v in rows])
    assert len(found) == len(rows)
    by_id = {r.vid: r for r in found}
    got = np.array([by_id[i].whitened for i, _ in rows])
    assert {r.n for r in found} == {n} and [int(by_id[i].deviation) for i, _ in rows] == deviation
    assert np.allclose(found[0].explained, values[: got.shape[1]] / trace, rtol=1e-10)
    assert all(r.identity_error < 1e-9 for r in found)
    for c in range(got.shape[1]):
        want = apart @ base[:, c] / math.sqrt(values[c])
        sign = np.sign(want @ got[:, c])
        assert np.abs(got[:, c] - sign * want).max() < rel * max(1, np.abs(want).max())
    return got.shape[1]


@pytest.mark.parametrize("length, count", [(48, 400), (5, 60), (2, 30)])
def test_components_equal_those_of_numpy(spark, length, count):
    rng = np.random.default_rng(length)
    points = rng.normal(size=(count, length)) * np.linspace(1, 0.2, length) + rng.normal(size=length)
    rows = [(i, [float(c) for c in p]) for i, p in enumerate(points)]
    rows += [(1000 + i, rows[i % 3][1]) for i in range(90)]  # copies weigh once
    assert check(rows, whiten_embeddings(frame(spark, rows)).collect()) == min(4, length)


def test_unsound_vectors_are_left_out(spark):
    good = [(i, [float(i % 7), -0.0 if i % 2 else 0.5, float(i * i % 5)]) for i in range(40)]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [1.0, float("nan"), 2.0]), (104, [float("inf"), 0.0, 0.0]),
           (105, [1e300, 0.0, 0.0])]
    found = whiten_embeddings(frame(spark, good + bad)).collect()
    assert {r.vid for r in found} == {i for i, _ in good}
    check(good, found)


def test_lengths_are_fitted_apart_and_flat_ones_have_no_component(spark):
    rows = [(i, [float(i), float(i * i % 3)]) for i in range(9)]
    flat = [(50, [1.0] * 5), (51, [1.0] * 5), (None, [1.0] * 5), (None, [1.0] * 5)]
    found = whiten_embeddings(frame(spark, rows + flat)).collect()
    check(rows, [r for r in found if r.length == 2])
    assert [(r.vid, r.n, r.whitened, int(r.deviation)) for r in found if r.length == 5 and r.vid] == [(50, 1, [], 0), (51, 1, [], 0)]
    assert sum(r.vid is None for r in found) == 2


def test_an_empty_table_gives_an_empty_frame(spark):
    assert whiten_embeddings(frame(spark, [])).count() == 0
    assert whiten_embeddings(frame(spark, [(1, None)])).count() == 0


def test_deviations_are_exact_beyond_64_bits():
    x = np.array([[2**40, -(2**45) + 1], [3, 2**50 + 7]])
    sums = [int(c) for c in x.sum(axis=0)]
    want = [sum((2 * int(a) - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    assert [int(v) for v in _deviations(x, 2, sums).to_pylist()] == want


@pytest.mark.parametrize("kind", ["normal", "decaying", "flat", "two"])
def test_pairs_reach_double_precision(kind):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 90))
    if kind == "decaying":
        x = x * np.geomspace(1e3, 1e-4, 90)
    elif kind == "flat":
        x = np.vstack([np.eye(90)] * 3)
    elif kind == "two":
        x = x[:, :2] @ rng.normal(size=(2, 90))
    x = x - x.mean(axis=0)
    cov = x.T @ x / len(x)
    values, base = leading_eigenpairs(lambda b: x.T @ (x @ b) / len(x), 90, 4)
    assert np.allclose(values, np.linalg.eigvalsh(cov)[::-1][:4], rtol=0, atol=1e-13 * values[0])
    assert np.abs(cov @ base - base * values).max() < 1e-13 * values[0]
    assert np.abs(base.T @ base - np.eye(4)).max() < 1e-13


def test_query_has_a_row_per_vector_and_component(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    found = QUERIES["op13_whitening"](spark, sf_dir)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = found.collect()
    assert {(r.vec_id, r.component) for r in rows} == {(i, c) for (i,) in given.select("vec_id").collect() for c in range(1, 5)}
    check([(r.vec_id, list(map(float, r.embedding))) for r in given.collect()], whiten_embeddings(given).collect())
