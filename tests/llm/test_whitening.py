import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from residua.llm.whitening import Whitening, qd_values, right_singular


def triangle(a):
    r = np.linalg.qr(a, mode="r")
    return np.vstack([r, np.zeros((a.shape[1] - len(r), a.shape[1]))])


def check(a, most):
    values, vectors = right_singular(triangle(a), most)
    want = np.zeros(a.shape[1])
    want[: min(a.shape)] = np.linalg.svd(a, compute_uv=False)
    top = max(want[0], 1e-300)
    assert np.abs(values - want[: len(values)]).max() <= 1e-13 * a.shape[1] * top
    assert np.abs(vectors @ vectors.T - np.eye(len(vectors))).max() <= 1e-13 * a.shape[1]
    assert np.abs(a.T @ (a @ vectors.T) - vectors.T * values**2).max() <= 1e-13 * a.shape[1] * top**2


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 30), st.integers(1, 60), st.sampled_from(["plain", "graded", "tied", "zero column", "whole"]))
def test_solver(seed, width, rows, kind):
    rng = np.random.default_rng(seed)
    a = rng.normal(size=(rows, width))
    if kind == "graded":
        a *= 10.0 ** rng.uniform(-5, 5, width)
    elif kind == "tied":
        a[:, 0] = a[:, -1]
    elif kind == "zero column":
        a[:, rng.integers(width)] = 0
    elif kind == "whole":
        a = np.round(a)
    check(a, min(width, 6))


@pytest.mark.parametrize("a", [np.eye(7), np.diag([3.0, 3, 3, 1, 1, 0]), np.zeros((4, 3)), np.ones((9, 4)), np.kron(np.eye(3), [[1.0, 2], [3, 4]]), np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1) + np.diag(np.abs(np.arange(-10, 11.0)))])
def test_ties_and_gaps(a):
    check(a, a.shape[1])


def test_small_values_keep_their_digits():
    """A bidiagonal matrix whose singular values span 12 decades: the qd algorithm gives each to nearly full relative accuracy."""
    from fractions import Fraction

    a, b = [10.0**-k for k in range(7)], [0.5 * 10.0**-k for k in range(6)]
    q, e = [v * v for v in a], [v * v for v in b]

    def below(x):
        """Eigenvalues of B'B under x, by exact Sturm counts."""
        count, d = 0, None
        for k in range(7):
            t = Fraction(q[k]) + (Fraction(e[k - 1]) if k else 0)
            d = t - x - (Fraction(q[k - 1]) * Fraction(e[k - 1]) / d if k else 0)
            count += d < 0
        return count

    for k, v in enumerate(sorted(qd_values(np.array(q), np.array(e)))):
        assert below(Fraction(v) * (1 - Fraction(1, 10**13))) <= k < below(Fraction(v) * (1 + Fraction(1, 10**13)))


def by_hand(vectors, most=4):
    kept = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(v) for _, v in kept), default=0)
    kept = [(i, tuple(v + [0] * (width - len(v)))) for i, v in kept]
    fit = sorted({v for _, v in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)] if fit else []
    c = np.array(fit, float) - np.array(sums, float) / n
    values, directions = np.linalg.eigh(c.T @ c / n)
    values, directions = values[::-1][:most], directions[:, ::-1][:, :most]
    out = []
    for i, v in kept:
        out.append((i, sum((n * x - s) ** 2 for x, s in zip(v, sums)), (np.array(v, float) - np.array(sums, float) / n) @ directions / np.sqrt(values)))
    return n, out, values / np.trace(c.T @ c / n)


@pytest.mark.parametrize("seed, width, rows", [(1, 9, 400), (2, 64, 90), (3, 3, 50)])
def test_by_hand(spark, seed, width, rows):
    rng = np.random.default_rng(seed)
    hot = [float(v) for v in rng.normal(size=width)]
    vectors = [(i, hot if i % 3 == 0 else [float(v) for v in rng.normal(size=width) * np.arange(1, width + 1)]) for i in range(rows)]
    vectors += [(rows, None), (rows + 1, []), (rows + 2, [None] * width), (rows + 3, [float("nan")] + [0.0] * (width - 1)), (rows + 4, [float("inf")] * width), (None, hot), (5, vectors[4][1]), (rows + 5, hot[:2]), (rows + 6, [-0.0] * width)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").repartition(11)
    model = Whitening(components=min(width, 4)).fit(df)
    n, want, explained = by_hand(vectors, min(width, 4))
    out = model.transform(df.withColumn("row", F.lit(1)).withColumn("x", F.lit("x")).withColumn("Whitened", F.lit("gone")))
    assert out.columns == ["vec_id", "embedding", "row", "x", "deviation", "whitened"]
    order = lambda r: (str(r[0]), r[1], np.round(np.abs(r[2]), 6).tolist())
    got = sorted(((r["vec_id"], r["deviation"], np.array(r["whitened"])) for r in out.collect()), key=order)
    want = sorted(want, key=order)
    assert model.n == n and [g[:2] for g in got] == [w[:2] for w in want]
    a, b = np.array([g[2] for g in got]), np.array([w[2] for w in want])
    assert np.abs(a * np.sign((a * b).sum(axis=0)) - b).max() < 1e-9
    assert np.allclose(model.explained, explained, rtol=1e-10) and model.identity_error < 1e-10


def test_nothing_to_whiten(spark):
    schema = "vec_id long, embedding array<float>"
    none = spark.createDataFrame([], schema)
    model = Whitening().fit(none)
    assert model.transform(none).count() == 0 and model.n == 0 and model.identity_error is None
    hollow = spark.createDataFrame([(1, []), (2, [])], schema)
    assert [tuple(r) for r in Whitening().fit(hollow).transform(hollow).select("deviation", "whitened").collect()] == [(0, []), (0, [])]
    one = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)
    model = Whitening().fit(one)
    assert model.n == 1 and model.explained == [None, None]
    assert [tuple(r) for r in model.transform(one).select("deviation", "whitened").collect()] == [(0, [None, None])] * 2
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(9)], schema)
    model = Whitening().fit(line)
    assert all(r["whitened"][1:] == [None, None] and r["whitened"][0] is not None for r in model.transform(line).collect())
    assert model.identity_error < 1e-12


def test_range(spark):
    df = spark.createDataFrame([(1, [1e30]), (2, [1.0])], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="outside the range"):
        Whitening().fit(df)
    wide = spark.createDataFrame([(i, [4e9 if i else -4e9] * 3) for i in range(3)], "vec_id long, embedding array<double>")
    assert all(r["deviation"] is None or r["deviation"] >= 0 for r in Whitening().fit(wide).transform(wide).collect())
