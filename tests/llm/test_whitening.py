import math
import random

import numpy as np
import pytest

from jobweave.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, deviation string, whitened int, component int"


def brute(rows, k):
    """The whole result by dense linear algebra; signs are the library's."""
    kept = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    if not kept:
        return []
    d = max(len(x) for _, x in kept)
    kept = [(i, x + [1_000_000] * (d - len(x))) for i, x in kept]
    fit = np.array(sorted({tuple(x) for _, x in kept}))
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    out = []
    for i, x in kept:
        dev = [n * a - int(s) for a, s in zip(x, sums)]
        for c in range(len(values)):
            flat = values[c] <= 1e-12 * max(values[0], 1)
            out.append((i, c + 1, n, sum(a * a for a in dev), None if flat else abs(np.array(dev, float) / n @ vectors[:, c]) / values[c] ** 0.5, values[c]))
    return out


def check(spark, rows, k=16):
    docs = spark.createDataFrame([(i, v, 1, "x", "y", 2, 3) for i, v in rows], SCHEMA).repartition(4)
    got = whitening.components(docs, k=k).collect()
    want = brute(rows, k)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    got, want = sorted(got, key=lambda r: (*key(r), abs(r[4] or 0))), sorted(want, key=lambda r: (*key(r), r[4] or 0))
    assert [tuple(r)[:4] for r in got] == [w[:4] for w in want]
    for g, w in zip(got, want):
        assert (g["whitened"] is None) == (w[4] is None)
        if w[4] is not None:
            assert abs(abs(g["whitened"]) - w[4]) < 1e-7 * max(1, w[4])
            assert g["identity_error"] < 1e-9
    return got


def test_against_dense_algebra(llm):
    rng = np.random.default_rng(1)
    turn = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    data = (rng.normal(size=(400, 40)) * np.linspace(3, 0.2, 40)) @ turn
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(data)]
    rows += rows[:5] + [(None, rows[3][1]), (900, None), (901, [None] * 40), (902, [float("nan")] * 40), (903, [float("inf"), *[0.0] * 39]), (904, rows[0][1][:30]), (905, [])]
    rows += [(1000 + i, rows[7][1]) for i in range(200)]
    random.Random(2).shuffle(rows)
    got = check(llm, rows)
    assert abs(sum({r["component"]: r["explained"] for r in got}.values()) - 1) < 1


@pytest.mark.parametrize("rows", [
    [], [(1, None), (2, [float("nan")])], [(1, [0.5, 0.25])], [(1, [0.5, 0.25]), (2, [0.5, 0.25])],
    [(1, [1.0, 2.0, 3.0]), (2, [2.0, 4.0, 6.0]), (3, [-1.0, -2.0, -3.0])], [(1, [1e6, -1e6]), (2, [1.0, 3.0]), (3, [0.0, 1e7])], [(1, []), (2, [])],
])
def test_small_tables(llm, rows):
    """Empty, one vector, one line, large numbers."""
    check(llm, rows)


def test_many_dimensions_with_restarts():
    """Close eigenvalues, more dimensions than the search space may have."""
    rng = np.random.default_rng(4)
    d, k = 300, 6
    q = np.linalg.qr(rng.normal(size=(d, d)))[0]
    values = np.concatenate([[9, 8.99, 8.99, 7, 6.5, 6.49], np.linspace(6, 0.1, d - 6)])
    v = (q * values) @ q.T
    products = []
    found, vectors, residuals = whitening.jacobi_davidson(lambda y: products.append(y.shape[1]) or v @ y, d, k, values.sum())
    assert np.allclose(found, values[:k], atol=1e-11) and max(products) < d
    assert residuals.max() < 20 * np.finfo(float).eps * values.sum()
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12


def test_sums_beyond_64_bits():
    x = np.array([[2**40, 0], [0, 2**40]])
    exact = whitening.deviations(x, 2**30, np.array([2**69, 5], dtype=object))
    assert exact[0].tolist() == [2**70 - 2**69, -5]
