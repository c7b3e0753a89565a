"""Whitening against numpy, with odd rows, repeated rows, empty tables and sums beyond 64 bits."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from rillrank.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, component string, _x int"


def vectors(n=200, d=7, seed=3):
    rnd = np.random.default_rng(seed)
    return (rnd.normal(size=(n, d)) @ rnd.normal(size=(d, d))).astype(np.float32)


def table(spark, values):
    return spark.createDataFrame([(i, v, "c", 1) for i, v in enumerate(values)], SCHEMA).repartition(3)


def run(spark, values, components=4):
    df = table(spark, values)
    model = whitening.fit(df, "embedding", components)
    rows = whitening.whiten(df, model, "embedding", "vec_id").collect()
    return model, {(r.vec_id, r.component): r for r in rows}, len(rows)


def test_against_numpy(spark):
    values = vectors()
    given = [v.tolist() for v in values] + [values[0].tolist()] * 50 + [None, [], [1.0] * 3, [float("nan")] * 7,
                                                                      [math.inf] + [0.0] * 6, [None] + [0.0] * 6]
    model, rows, count = run(spark, given)
    x = np.floor(256 * values.astype(np.float64)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    v = np.cov(fit.T.astype(float), bias=True)
    values_, axes = np.linalg.eigh(v)
    assert model.n == n and count == 4 * 250 and {i for i, _ in rows} == set(range(250))
    for i in (*range(200), 249):
        at = x[i] if i < 200 else x[0]
        for k in range(1, 5):
            r = rows[i, k]
            assert r.n == n and r.deviation == ((n * at - sums) ** 2).sum()
            assert abs(r.explained / (values_[-k] / np.trace(v)) - 1) < 1e-9 and r.identity_error < 1e-9
            want = (at - sums / n) @ axes[:, -k] / math.sqrt(values_[-k])
            assert abs(abs(r.whitened) - abs(want)) < 1e-9
    white = np.array([[rows[i, k].whitened for k in range(1, 5)] for i in range(200)])
    _, first = np.unique(x, axis=0, return_index=True)
    assert np.abs(np.cov(white[first].T, bias=True) - np.eye(4)).max() < 1e-9


def test_polarisation_is_exact():
    """The matrix from sums of squares is the centred covariance, in fractions."""
    rnd = random.Random(1)
    x = np.array([[rnd.randrange(-10 ** 6, 10 ** 6) for _ in range(4)] for _ in range(9)])
    n, sums = len(x), tuple(int(s) for s in x.sum(axis=0))
    squares = dict(whitening._pair_squares(n, sums)(x))
    v = whitening.covariance(squares, 4, n)
    for i in range(4):
        for j in range(4):
            exact = sum((Fraction(int(r[i])) - Fraction(sums[i], n)) * (Fraction(int(r[j])) - Fraction(sums[j], n)) for r in x) / n
            assert v[i, j] == float(exact)


@pytest.mark.parametrize("bits", [3, 21, 22, 23, 44, 45, 60])
def test_square_sums(bits):
    rnd = random.Random(bits)
    p = np.array([[rnd.randrange(-(1 << bits), 1 << bits) for _ in range(3)] for _ in range(50)])
    want = [sum(v * v for v in column) for column in p.T.tolist()]
    assert whitening.square_sums(p) == want and whitening.square_sums(p.astype(object)) == want


def test_large_numbers_stay_exact():
    x = np.array([[1 << 60, -5], [3, 1 << 61]])
    u = whitening.centred(x, 1 << 20, (7, 9))
    assert u.tolist() == [[(1 << 80) - 7, -(5 << 20) - 9], [(3 << 20) - 7, (1 << 81) - 9]]


@pytest.mark.parametrize("values, components", [([[1.0, 2.0]], 0), ([[1.0, 2.0]] * 5, 0), ([[0.0, 0.0], [1.0, 2.0]], 1),
                                                ([[0.0], [1.0], [5.0]], 1), ([], 0), ([None], 0), ([[]], 0)])
def test_few_or_no_components(spark, values, components):
    _, rows, count = run(spark, values)
    assert count == components * len(values)


def test_the_common_length_counts(spark):
    _, rows, count = run(spark, [[1.0, 2.0, 3.0], [2.0, 1.0, 5.0], [0.5, 1.0], [3.0, 3.0, 3.5]])
    assert {i for i, _ in rows} == {0, 1, 3}


def test_what_cannot_be_exact_stops(spark):
    with pytest.raises(Exception, match="beyond"):
        run(spark, [[1e30, 1.0], [2.0, 3.0]])
