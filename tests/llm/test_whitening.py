"""Whitening against numpy's eigenvectors and exact integers."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import queries, whitening

FOLDER = "/root/testdata/sf0.001"


def matrices():
    draw = np.random.default_rng(5)
    plain = draw.standard_normal((40, 40))
    yield plain @ plain.T
    basis, _ = np.linalg.qr(draw.standard_normal((30, 30)))
    close = np.concatenate([np.full(6, 5.0), [4.0, 4.0 - 1e-12, 3.0], np.linspace(2, 0.5, 21)])
    yield (basis * close) @ basis.T
    yield np.eye(7)
    yield np.diag([3.0, 1.0, 2.0, 2.0])
    yield np.array([[2.0]])
    yield np.array([[2.0, 1.0], [1.0, 2.0]]) * 1e12
    thin = draw.standard_normal((12, 3))
    yield thin @ thin.T


@pytest.mark.parametrize("matrix", list(matrices()), ids=range(7))
def test_components_are_eigenvectors(matrix):
    values, vectors = whitening.leading_components(matrix, 32)
    expected = np.sort(np.linalg.eigvalsh(matrix))[::-1][:32]
    expected = expected[expected > whitening.RANK * expected[0]]
    scale = np.abs(matrix).max()
    assert np.allclose(values, expected, rtol=0, atol=1e-13 * scale * len(matrix))
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-13 * scale * len(matrix)


def test_sturm_counts():
    diagonal, below = np.array([2.0, 2.0, 2.0]), np.array([1.0, 1.0])
    shifts = np.array([0.0, 1.0, 2.5, 4.0])
    assert whitening.sturm_counts(diagonal, below, shifts).tolist() == [0, 1, 2, 3]


def brute(rows):
    """Rows by component of (vec_id, n, deviation, whitened up to sign, explained)."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in rows]
    n, size = len(x), len(x[0])
    sums = [sum(row[i] for row in x) for i in range(size)]
    centred = np.array([[float(Fraction(n * row[i] - sums[i], n)) for i in range(size)] for row in x])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(values)[::-1][:32]
    whitened = centred @ vectors[:, order] / np.sqrt(values[order])
    deviation = [sum((n * row[i] - sums[i]) ** 2 for i in range(size)) for row in x]
    return n, deviation, whitened, values[order] / values.sum()


def test_query_matches_brute_force(spark):
    found = queries.QUERIES["op13_whitening"](spark, FOLDER).collect()
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet").orderBy("vec_id").collect()
    rows = [(r.vec_id, r.embedding) for r in table if r.embedding is not None and all(c is not None and math.isfinite(c) for c in r.embedding)]
    n, deviation, whitened, explained = brute(rows)
    assert len(found) == n * whitened.shape[1]
    place = {vec_id: i for i, (vec_id, _) in enumerate(rows)}
    mine = np.zeros(whitened.shape)
    for row in found:
        mine[place[row.vec_id], row.component - 1] = row.whitened
        assert row.n == n and row.deviation == deviation[place[row.vec_id]]
        assert row.explained == pytest.approx(explained[row.component - 1], rel=1e-9)
        assert 0 <= row.identity_error < 1e-9
    signs = np.sign((mine * whitened).sum(axis=0))
    assert np.abs(mine - whitened * signs).max() < 1e-7
    assert np.abs(np.cov(mine.T, bias=True) - np.eye(mine.shape[1])).max() < 1e-9


def test_odd_vectors(spark):
    draw = np.random.default_rng(1)
    good = [(i % 9 if i else None, [float(c) for c in draw.standard_normal(4)]) for i in range(20)]
    bad = [
        (50, None), (51, []), (52, [1.0, None, 2.0, 3.0]), (53, [1.0, float("nan"), 2.0, 3.0]), (54, [1.0, float("inf"), 2.0, 3.0]),
        (55, [1.0, 2.0, 3.0]), (56, [1e30, 0.0, 0.0, 0.0]),
    ]
    rows = [(vec_id, v, "x", i, i) for i, (vec_id, v) in enumerate(good + bad)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, component string, n int, Whitened int")
    found = whitening.whiten(frame.repartition(3)).collect()
    assert len(found) == 20 * 4 and {row.vec_id for row in found} == {i for i, _ in good}
    n, deviation, _, _ = brute([(i, np.float32(v)) for i, v in good])
    assert sorted(row.deviation for row in found if row.component == 2) == sorted(deviation) and found[0].n == n


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]], ids=range(4))
def test_nothing_to_whiten(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    assert whitening.whiten(frame).collect() == []


def test_fewer_vectors_than_dimensions(spark):
    draw = np.random.default_rng(2)
    frame = spark.createDataFrame([(i, [float(c) for c in draw.standard_normal(8)]) for i in range(4)], "vec_id bigint, embedding array<double>")
    found = whitening.whiten(frame).collect()
    assert {row.component for row in found} == {1, 2, 3} and sum(row.explained for row in found) == pytest.approx(4)


def test_deviation_beyond_a_long_is_null():
    x = np.array([[1 << 40, 0], [0, 0]])
    assert whitening._deviations(x, 2, (1 << 40, 0), np.array([2.0**39, 0.0])) == [None, None]
    assert whitening._deviations(x[1:], 2, (4, 6), np.array([2.0, 3.0])) == [52]
