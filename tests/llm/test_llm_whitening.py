"""Whitening against NumPy's dense eigensolver, and the small solver on matrices that are hard to treat."""

import math
from collections import defaultdict

import numpy as np
import pytest
from llm_helpers import rows_of

from lamina.llm import bidiagonal, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, n long, x string, v int, component string"


def vectors_of(spark, pairs):
    """An embeddings table with extra columns whose names clash."""
    return spark.createDataFrame([(i, v, 0, 1, "x", 2, "c") for i, v in pairs], SCHEMA).repartition(5)


def plainly(pairs, components=16):
    """Result rows by component from the definition, with exact integers and a dense solver."""
    usable = [(i, v) for i, v in pairs if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    points = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in usable]
    distinct = sorted({tuple(x) for _, x in points})
    n, sums = len(distinct), [sum(column) for column in zip(*distinct)]
    scaled = lambda x: [n * a - s for a, s in zip(x, sums)]
    centred = np.array([scaled(x) for x in distinct], float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    found = {}
    for k, at in enumerate(order, 1):
        if values[at] > 1e-9 * values.max():
            found[k] = (
                float(values[at] / values.sum()),
                [(i, sum(a * a for a in scaled(x)), float(np.array(scaled(x), float) / n @ vectors[:, at] / math.sqrt(values[at]))) for i, x in points],
            )
    return n, found


def compare(spark, pairs, components=16):
    n, expected = plainly(pairs, components)
    found = defaultdict(list)
    for row in rows_of(whitening.report(vectors_of(spark, pairs), components)):
        assert row["n"] == n and row["identity_error"] < 1e-9
        found[row["component"]].append(row)
    assert sorted(found) == sorted(expected)
    for k, (share, rows) in expected.items():
        got = found[k]
        assert all(abs(r["explained"] - share) <= 1e-10 * share for r in got)
        by_id = {i: (deviation, value) for i, deviation, value in rows}
        assert sorted(str(r["vec_id"]) for r in got) == sorted(str(i) for i, _, _ in rows)
        largest = max(got, key=lambda r: abs(r["whitened"]))
        sign = math.copysign(1, largest["whitened"] * by_id[largest["vec_id"]][1])
        for r in got:
            assert r["deviation"] == by_id[r["vec_id"]][0]
            assert abs(sign * r["whitened"] - by_id[r["vec_id"]][1]) < 1e-8


def test_rows_equal_a_dense_solver(spark):
    draws = np.random.default_rng(1)
    base = draws.standard_normal((400, 24)) * np.linspace(3, 0.2, 24)
    pairs = [(i, v.tolist()) for i, v in enumerate(base)]
    pairs += [(1000 + i, base[7].tolist()) for i in range(300)]
    pairs += [(None, base[8].tolist()), (2000, None), (2001, [float("nan")] * 24), (2002, [None, *([1.0] * 23)])]
    pairs += [(2003, [float("inf"), *([1.0] * 23)])]
    compare(spark, pairs)


def test_fewer_dimensions_than_components(spark):
    draws = np.random.default_rng(2)
    compare(spark, [(i, draws.standard_normal(5).tolist()) for i in range(60)])
    # Two dimensions depend on others, one is constant.
    flat = [(i, [a, a, b, 0.5, b, c]) for i, (a, b, c) in enumerate(draws.standard_normal((50, 3)).tolist())]
    compare(spark, flat)
    compare(spark, [(0, [0.0, 1.0]), (1, [2.0, 5.0]), (1, [2.0, 5.0])])


def test_nothing_to_whiten(spark):
    for pairs in ([], [(1, None)], [(1, [1.0, 2.0])] * 3, [(1, [])], [(1, [None])]):
        result = whitening.report(vectors_of(spark, pairs))
        assert result.collect() == [] and result.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_other_lengths_are_left_out(spark):
    pairs = [(i, [float(i), float(i * i % 7)]) for i in range(20)]
    both = [rows_of(whitening.report(vectors_of(spark, [*pairs, *more]))) for more in ([], [(99, [1.0]), (98, [])])]
    same, found = (sorted((r["vec_id"], r["component"], r["deviation"], round(r["whitened"], 9)) for r in rows) for rows in both)
    assert same == found and len(same) == 40


def test_deviations_stay_exact_beyond_64_bits(spark):
    pairs = [(0, [3e30, 1.0]), (1, [-3e30, 2.0]), (2, [0.0, 3.0]), (3, [1.0, 1e9])]
    rows = rows_of(whitening.report(vectors_of(spark, pairs)))
    assert {r["vec_id"] for r in rows if r["deviation"] is None} >= {0, 1} and len(rows) == 8


def test_many_blocks_and_a_tree_of_factors(spark, monkeypatch):
    draws = np.random.default_rng(4).standard_normal((300, 6)).tolist()
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    compare(spark, list(enumerate(draws)), 4)


@pytest.mark.parametrize("kind", ["random", "same", "multiple", "graded", "close", "wilkinson", "flat"])
def test_small_solver(kind):
    draws = np.random.default_rng(0)
    turn = lambda size: np.linalg.qr(draws.standard_normal((size, size)))[0]
    matrix = {
        "random": lambda: np.linalg.qr(draws.standard_normal((500, 64)), mode="r"),
        "same": lambda: 3 * np.eye(30),
        "multiple": lambda: turn(40) @ np.diag([5.0] * 10 + [3.0] * 10 + [1.0] * 20) @ turn(40),
        "graded": lambda: turn(30) @ np.diag(10.0 ** -np.arange(30)) @ turn(30),
        "close": lambda: turn(40) @ np.diag(1 + 1e-9 * np.arange(40)) @ turn(40),
        "wilkinson": lambda: np.linalg.cholesky(np.diag(np.abs(np.arange(-10, 11)) + 20.0) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)).T,
        "flat": lambda: np.ones((9, 9)),
    }[kind]()
    values, vectors = bidiagonal.principal(matrix, 64)
    singular = np.linalg.svd(matrix, compute_uv=False)[: len(values)]
    assert np.allclose(np.sqrt(values), singular, rtol=1e-12, atol=1e-13 * singular[0])
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-11
    assert np.abs(matrix.T @ (matrix @ vectors) - vectors * values).max() < 1e-13 * singular[0] ** 2 * len(matrix)


def test_small_values_keep_their_digits():
    """A graded matrix whose smallest value a dense solver loses: the product of all is the determinant."""
    a = 10.0 ** -np.arange(20)
    values = bidiagonal.dqds(a, a[:-1] / 2)
    assert abs(np.log(values).sum() - 2 * np.log(a).sum()) < 1e-9
