"""Whitening against numpy and exact fractions, roots and multiplicities against matrices made to order."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from wardgrid.llm import shared, whitening

EMBEDDINGS = "vec_id long, embedding array<float>, label int"


@pytest.fixture(scope="module", autouse=True)
def importable(spark):
    shared.prepare(spark)


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], EMBEDDINGS)


def expected(vectors, components=16):
    """Per component: (explained, |projection| of each vector), and n, deviations, by numpy and Python integers."""
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]
    fit = sorted({tuple(v) for v in x})
    n, d = len(fit), len(fit[0])
    sums = [sum(v[j] for v in fit) for j in range(d)]
    deviation = [sum((n * v[j] - sums[j]) ** 2 for j in range(d)) for v in x]
    centred = np.array([[float(Fraction(n * v[j] - sums[j], n)) for j in range(d)] for v in fit])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    rows = np.array([[float(Fraction(n * v[j] - sums[j], n)) for j in range(d)] for v in x])
    return n, deviation, values[order] / values.sum(), np.abs(rows @ axes[:, order] / np.sqrt(values[order]))


def test_whitened_rows_match_numpy(spark):
    draw = np.random.default_rng(2)
    vectors = (draw.normal(size=(300, 20)) * np.linspace(0.5, 8, 20)).astype(np.float32).tolist()
    vectors += vectors[:7]
    n, deviation, explained, size = expected(vectors)
    got = whitening.whiten(spark, table(spark, vectors)).collect()
    assert len(got) == len(vectors) * 16 and {r["n"] for r in got} == {n} and n == 300
    for r in got:
        assert r["deviation"] == deviation[r["vec_id"]]
        assert abs(r["explained"] - explained[r["component"] - 1]) < 1e-12
        assert abs(abs(r["whitened"]) - size[r["vec_id"], r["component"] - 1]) < 1e-9
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-10


def test_equal_eigenvalues_and_missing_rank(spark):
    # Corners of a cross: all variances are equal. A third entry that is always zero has none.
    vectors = [[1.0, 0.0, 0.0], [-1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, -1.0, 0.0]]
    got = whitening.whiten(spark, table(spark, vectors)).collect()
    assert len(got) == 8 and {r["component"] for r in got} == {1, 2}
    assert all(abs(r["explained"] - 0.5) < 1e-15 for r in got) and got[0]["identity_error"] < 1e-12
    lengths = {}
    for r in got:
        lengths[r["vec_id"]] = lengths.get(r["vec_id"], 0) + r["whitened"] ** 2
    assert all(abs(v - 2) < 1e-12 for v in lengths.values())


def test_nulls_lengths_and_constant_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [None, [1.0, None], [nan, 1.0], [1.0, inf], [], [1.0, 2.0], [2.0, 1.0], [2.0, 1.0], [1.0], [3.0], [5.0]]
    docs = table(spark, vectors)
    got = whitening.whiten(spark, docs).collect()
    assert sorted((r["vec_id"], r["component"], r["n"]) for r in got) == [(5, 1, 2), (6, 1, 2), (7, 1, 2), (8, 1, 3), (9, 1, 3), (10, 1, 3)]
    assert whitening.whiten(spark, docs.limit(0)).collect() == []
    assert whitening.whiten(spark, table(spark, [[1.0, 1.0]] * 3)).collect() == []


def test_large_values_stay_exact(spark):
    vectors = [[1e12, 1.0], [-3e11, 5.0], [7.0, 1e16], [2.0, 4.0]]
    n, _, explained, size = expected(vectors)
    got = whitening.whiten(spark, table(spark, vectors)).collect()
    assert {r["deviation"] for r in got} == {None}
    for r in got:
        assert abs(r["explained"] - explained[r["component"] - 1]) < 1e-12
    z = np.array([[3, -(1 << 40), (1 << 62) - 5], [-(1 << 61), 77, 12]], np.int64)
    plain = [[sum(int(a) * int(b) for a, b in zip(z[:, i], z[:, j])) for j in range(3)] for i in range(3)]
    assert whitening.scatter(z).tolist() == plain
    assert whitening.column_sums(z).tolist() == [sum(map(int, z[:, j])) for j in range(3)]


def test_polynomial_roots_and_multiplicities(spark):
    draw = np.random.default_rng(4)
    m = draw.integers(-9, 9, (9, 7))
    matrix = (m.T @ m).tolist()
    f = whitening.characteristic_polynomial(spark, matrix)
    assert np.allclose(np.array(f[::-1], float), np.poly(np.array(matrix, float)), rtol=1e-9)
    roots = whitening.largest_roots(f, 7)
    values = [Fraction(r.low + r.high, 2 << r.bits) for r in roots]
    assert np.allclose([float(v) for v in values], np.sort(np.linalg.eigvalsh(np.array(matrix)))[::-1], rtol=1e-9)
    # (x - 3)^2 (x - 5) x^2 (x - 4)^3, whole roots that bisection meets exactly
    g = [1]
    for root in (3, 3, 5, 0, 0, 4, 4, 4):
        g = [a - root * b for a, b in zip([0, *g], [*g, 0])]
    assert [(float(r.high / 2**r.bits), r.times) for r in whitening.largest_roots(g, 99)] == [(5, 1), (4, 3), (3, 2)]
    # Two roots closer than a whole number apart: x^2 - 6 x + 7 = 0 at 3 +- sqrt 2, and (4 x - 9)(4 x - 10)
    assert [round(r.high / 2**r.bits, 9) for r in whitening.largest_roots([7, -6, 1], 2)] == [round(3 + 2**0.5, 9), round(3 - 2**0.5, 9)]


def test_close_eigenvalues_give_accurate_vectors():
    big = 10**12
    matrix = [[big + 1, 0, 0], [0, big, 0], [0, 0, 5]]
    spin = np.array([[2, -2, 1], [1, 2, 2], [2, 1, -2]], object)  # 3 times a rotation
    turned = spin @ np.array(matrix, object) @ spin.T
    vector = whitening.null_space(turned.tolist(), 9 * (big + 1) << 192, 192, 1)[0]
    assert np.allclose(np.abs(vector), np.abs(np.array(spin[:, 0], float)) / 3, atol=1e-15)
    # A root that is off by 2^-60 of itself: the step of inverse iteration makes up for it.
    rough = whitening.null_space(turned.tolist(), (9 * (big + 1) << 192) + (1 << 172), 192, 1)[0]
    assert np.allclose(np.abs(rough), np.abs(np.array(spin[:, 0], float)) / 3, atol=1e-15)
    pair = whitening.null_space((spin @ np.diag([7, 7, 1]).astype(object) @ spin.T).tolist(), 63 << 192, 192, 2)
    assert np.allclose(pair @ pair.T, np.eye(2), atol=1e-15) and np.allclose(pair @ np.array(spin[:, 2], float), 0, atol=1e-15)
