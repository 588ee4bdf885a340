"""Whitening against a dense eigendecomposition and exact whole numbers."""

from __future__ import annotations

import math

import numpy as np
import pytest

from tickhouse.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n int, key string"


def reference(rows, components=16):
    """Plain model: {vec_id: (n, deviation)}, whitened matrix per distinct row."""
    kept = [
        (i, [math.floor(64 * float(np.float32(c))) + 1000000 for c in v])
        for i, v in rows
        if v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    y = np.array([[float(c) - s / n for c, s in zip(x, sums, strict=True)] for x in fit])
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    trace = np.trace(y.T @ y / n)
    out = []
    for i, x in kept:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))
        white = (np.array([c - s / n for c, s in zip(x, sums, strict=True)]) @ vectors) / np.sqrt(values)
        out.append((i, n, deviation, white, values / trace))
    return out


def frame(spark, rows):
    wide = [(i, v, 1, "x", 2, "k") for i, v in rows]
    return spark.createDataFrame(wide, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(4)
    scales = np.linspace(0.05, 1.5, 20)
    plain = [(i, (r.standard_normal(20) * scales).tolist()) for i in range(300)]
    return [
        *plain,
        plain[3],  # a repeated row
        (900, plain[5][1]),  # the same vector under another key
        (901, None),
        (902, [None, *plain[0][1][1:]]),
        (903, [float("nan"), *plain[0][1][1:]]),
        (904, [float("-inf"), *plain[0][1][1:]]),
        (None, plain[7][1]),
    ]


def test_equals_the_dense_model(spark, rows):
    got = {}
    for r in whitening.whitened(frame(spark, rows)).collect():
        got.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    want = reference(rows)
    assert set(got) == {i for i, *_ in want}
    assert sum(len(v) for per in got.values() for v in per.values()) == 16 * len(want)
    flips = None
    for i, n, deviation, white, explained in want:
        mine = [got[i][c][0] for c in range(1, 17)]
        assert {(r.n, r.deviation) for r in mine} == {(n, deviation)}
        vector = np.array([r.whitened for r in mine])
        flips = np.sign(vector * white) if flips is None else flips  # one sign for all rows
        np.testing.assert_allclose(vector * flips, white, atol=1e-8)
        np.testing.assert_allclose([r.explained for r in mine], explained, rtol=1e-9)
        assert max(r.identity_error for r in mine) < 1e-9
    assert len(got[3][1]) == 2  # repeated rows each have theirs


def test_rank_below_the_number_of_components(spark):
    r = np.random.default_rng(1)
    flat = r.integers(-20, 20, (50, 3)) / 4
    rows = [(i, [*v.tolist(), float(v.sum()), 0.5]) for i, v in enumerate(flat)]
    got = whitening.whitened(frame(spark, rows)).collect()
    assert {r.component for r in got} == {1, 2, 3}
    assert max(r.identity_error for r in got) < 1e-9


@pytest.mark.parametrize("rows", [[], [(1, [0.5, 2.0])], [(1, [0.5]), (2, [0.5])], [(1, [])], [(1, None)]])
def test_nothing_to_whiten_gives_no_rows(spark, rows):
    assert whitening.whitened(frame(spark, rows)).collect() == []


def test_other_lengths_are_dropped_and_huge_entries_too(spark):
    rows = [(i, [float(i % 5), float(i % 3)]) for i in range(30)]
    got = whitening.whitened(frame(spark, [*rows, (77, [1.0]), (78, [1e30, 1.0])])).collect()
    assert {r.vec_id for r in got} == set(range(30))


def test_exact_deviation_beyond_doubles_and_beyond_longs(spark):
    """Deviations stay exact above 2^53 and become null above 2^63."""
    rows = [(i, [float(i * 4096), 0.0]) for i in range(100)]
    got = {r.vec_id: r.deviation for r in whitening.whitened(frame(spark, rows)).collect()}
    want = {i: d for i, _, d, *_ in reference(rows, 1)}
    assert got == want and max(want.values()) > 1 << 53
    rows = [(i, [float(i) * 2.0**32, 0.0]) for i in range(100)]
    got = {r.vec_id: r.deviation for r in whitening.whitened(frame(spark, rows)).collect()}
    want = {i: d for i, _, d, *_ in reference(rows, 1)}
    assert got == {i: d if d < 1 << 63 else None for i, d in want.items()}
    assert None in got.values()


def matrices():
    r = np.random.default_rng(2)
    q = np.linalg.qr(r.standard_normal((40, 40)))[0]
    x = r.standard_normal((500, 30))
    yield "plain", x.T @ x
    yield "one", np.array([[4.0]])
    yield "zero", np.zeros((5, 5))
    yield "equal", np.eye(12) * 3
    yield "two clusters", q @ np.diag([3.0] * 20 + [1.0] * 20) @ q.T
    yield "close", q @ np.diag(3 + 1e-12 * np.arange(40)) @ q.T
    yield "graded", q @ np.diag(10.0 ** -np.arange(40)) @ q.T
    yield "tiny", q @ np.diag(np.arange(40) * 1e-200) @ q.T
    yield "blocks", np.diag([5.0, 5, 5, 1, 1, 0])
    yield "rank one", np.ones((8, 8))


@pytest.mark.parametrize(("name", "matrix"), list(matrices()))
def test_eigenpairs(name, matrix):
    matrix = (matrix + matrix.T) / 2
    values, vectors = whitening.eigenpairs(matrix, 16)
    want = np.linalg.eigvalsh(matrix)[::-1][:16]
    scale = max(np.abs(want).max(), 1e-300)
    np.testing.assert_allclose(values / scale, want / scale, atol=1e-13)
    assert np.abs(matrix @ vectors - vectors * values).max() / scale < 1e-12
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12


def test_sturm_counts():
    diagonal, off = np.array([2.0, 2.0, 2.0, 2.0]), np.array([-1.0, -1.0, -1.0])
    values = 2 - 2 * np.cos(np.arange(1, 5) * np.pi / 5)
    at = np.linspace(-1, 5, 41)
    np.testing.assert_array_equal(
        whitening.sturm_counts(diagonal, off, at), [(values < a).sum() for a in at]
    )
