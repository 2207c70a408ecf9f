"""Whitening against numpy's own decomposition and exact whole-number arithmetic."""

import math

import numpy as np
import pytest

from chatloom.llm import whitening
from chatloom.llm.queries import LLM_QUERIES

from .conftest import SMALL


@pytest.mark.parametrize(
    "values",
    [
        [5.0], [3.0, 3.0], [9, 4, 1, 0.5], [1, 1, 1, 1, 1], [1e6, 1, 1e-6, 0, 0], [7, 7, 7, 2, 2, 1e-3],
        list(np.geomspace(1, 1e8, 40)), [0, 0, 0],
    ],
)
def test_eigen_equals_numpy(values):
    rng = np.random.default_rng(len(values))
    q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    matrix = q @ np.diag(values) @ q.T
    matrix = (matrix + matrix.T) / 2
    got, vectors = whitening.eigen(matrix)
    size = max(np.abs(values))
    assert np.allclose(got, np.sort(values)[::-1], atol=1e-13 * size, rtol=0)
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-13)
    assert np.linalg.norm(matrix @ vectors - vectors * got) <= 1e-12 * max(size, 1e-300)


@pytest.mark.parametrize("diagonal", [[4.0, 2, 1], [2, 2, 2], [1, 0, -1, 0]])
def test_polar_factor_of_a_diagonal_matrix_is_its_signs(diagonal):
    u = whitening.polar(np.diag(diagonal) - 0.5 * np.eye(len(diagonal)))
    assert np.allclose(u, np.diag(np.sign(np.array(diagonal) - 0.5)), atol=1e-14)


def brute(vectors, components):
    """(n, deviations, eigenvalues, whitened up to sign, trace) from plain Python and numpy."""
    x = [[math.floor(256 * float(np.float64(c))) + 0 for c in v] for v in vectors]
    fit = sorted({tuple(v) for v in x})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    mean = np.array([s / n for s in sums])
    centred = np.array(fit, float) - mean
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1], directions[:, ::-1]
    whitened = (np.array(x, float) - mean) @ directions[:, :components] / np.sqrt(values[:components])
    return n, deviation, values, whitened


def test_op12_equals_brute_force(spark):
    table = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()}
    table = {i: v for i, v in table.items() if v is not None and all(c is not None and math.isfinite(c) for c in v)}
    ids = sorted(table)
    n, deviation, values, whitened = brute([table[i] for i in ids], 4)
    rows = LLM_QUERIES["op12_qdwh_whitening"](spark, SMALL).collect()
    assert len(rows) == 4 * len(ids) and {r.n for r in rows} == {n}
    got = {(r.vec_id, r.component): r for r in rows}
    matrix = np.array([[got[i, k].whitened for k in range(1, 5)] for i in ids])
    signs = np.sign((matrix * whitened).sum(axis=0))
    assert np.allclose(matrix * signs, whitened, atol=1e-8)
    assert [got[i, 1].deviation for i in ids] == deviation
    for k in range(4):
        (explained,) = {r.explained for r in rows if r.component == k + 1}
        assert explained == pytest.approx(values[k] / values.sum(), rel=1e-9)
    assert max(r.identity_error for r in rows) < 1e-9


def test_op12_on_odd_rows(spark):
    schema = "vec_id long, embedding array<float>, component string, x int"
    inf, nan = float("inf"), float("nan")
    vectors = [
        (1, [1.0, 2.0]), (2, [-0.5, 0.25]), (2, [-0.5, 0.25]), (3, [0.001, -0.001]), (None, [3.0, 1.0]), (4, None), (5, [1.0, None]),
        (6, [nan, 1.0]), (7, [inf, 1.0]), (8, []), (9, [1.0, 2.0, 3.0]),
    ]
    rows = whitening.whiten(spark.createDataFrame([(*v, "c", 0) for v in vectors], schema)).collect()
    n, deviation, values, whitened = brute([v for _, v in vectors[:5]], 2)
    assert sorted(((r.vec_id or 0, r.component, r.deviation) for r in rows)) == sorted(
        (i or 0, k, d) for (i, _), d in zip(vectors[:5], deviation) for k in (1, 2)
    )
    assert {r.n for r in rows} == {4} and max(r.identity_error for r in rows) < 1e-12
    one = whitening.whiten(spark.createDataFrame([(1, [2.0, 1.0]), (2, [2.0, 1.0])], "vec_id long, embedding array<double>")).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained) for r in one] == [(1, 0, None, None)] * 4
    huge = whitening.whiten(spark.createDataFrame([(1, [1e300, 0.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<double>")).collect()
    assert {r.deviation for r in huge} == {None}
    for empty in ([], [(1, None, "c", 0)]):
        assert whitening.whiten(spark.createDataFrame(empty, schema)).count() == 0
