"""Spectral divide and conquer and the whitening built on it, against numpy's eigenvectors."""

import math

import numpy as np
import pytest

from wattline.llm import whitening as W


def symmetric(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    return (q * np.array(values, float)) @ q.T


@pytest.mark.parametrize("n", [1, 2, 5, 40])
def test_polar_factor(n):
    a = np.random.default_rng(n).standard_normal((n, n))
    u = W.polar(a)
    h = u.T @ a
    assert np.allclose(u.T @ u, np.eye(n), atol=1e-13) and np.allclose(h, h.T, atol=1e-12)
    assert np.linalg.eigvalsh((h + h.T) / 2).min() > -1e-12
    hard = symmetric([1e-14, 1e-9, -1e-5, 1, -2][:n] if n <= 5 else [*np.geomspace(1e-14, 1, n)])
    assert np.linalg.norm(W.polar(hard).T @ W.polar(hard) - np.eye(n)) < 1e-8


@pytest.mark.parametrize("values", [
    [3.0], [2.0, 1.0], [5.0] * 6, [0.0] * 4, [4, 4, 4, 1, 1, 0], np.geomspace(1, 1e12, 24), np.arange(64), [1e6] + [1.0] * 9,
    [1 + 1e-9 * i for i in range(8)], [2, 0, -2], [0, 0, 0, 7], np.random.default_rng(1).gamma(0.3, size=100)])
def test_components(values):
    a = symmetric(values, 3)
    got, vectors = W.components(a)
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-13)
    top = max(abs(v) for v in values) or 1.0
    assert np.abs(np.sort(values)[::-1] - got).max() <= 1e-13 * len(values) * top
    assert np.abs(a @ vectors - vectors * got).max() <= 1e-12 * len(values) * top
    few, some = W.components(a, 2)
    assert np.allclose(few, got[:2], rtol=1e-9, atol=1e-12 * top) and some.shape[1] == min(2, len(values))


def table(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return df.selectExpr("*", "1 as component", "2 as n", "'x' as x", "3 as dim", "4 as _key", "5 as whitened")


def reference(rows, factor=256.0, most=4):
    fine = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = {j: [math.floor(factor * float(np.float32(c))) for c in v] for j, (_, v) in enumerate(fine)}
    lengths = [len(v) for v in {tuple(v) for v in x.values()}]
    dim = max(set(lengths), key=lambda d: (lengths.count(d), d))
    fit = sorted({tuple(v) for v in x.values() if len(v) == dim})
    n, total = len(fit), [sum(c) for c in zip(*fit)]
    xs = np.array(fit, float)
    cov = np.cov(xs.T, bias=True).reshape(dim, dim)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = []
    for j, (i, _) in enumerate(fine):
        if len(x[j]) == dim:
            dev = sum((n * c - s) ** 2 for c, s in zip(x[j], total))
            y = (np.array(x[j], float) - xs.mean(0)) @ vectors / np.sqrt(np.maximum(values, 1e-300))
            out += [(i, k + 1, n, dev, abs(y[k]), values[k] / values.sum()) for k in range(min(most, dim)) if values[k] > 1e-9 * values[0]]
    return out


def check(spark, rows, **kw):
    got = W.whiten(table(spark, rows), **kw).collect()
    want = reference(rows, **kw)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3], r[4])
    got = sorted(((r["vec_id"], r["component"], r["n"], r["deviation"], abs(r["whitened"]), r["explained"]) for r in got), key=key)
    want.sort(key=key)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4] for g in got], [w[4] for w in want], atol=1e-9)
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)
    return got


def vectors(n, dim, seed=2):
    r = np.random.default_rng(seed)
    return (r.standard_normal((n, dim)) * np.geomspace(1, 0.05, dim)).astype(np.float32)


def test_equals_eigenvectors(spark):
    rows = [(i, v.tolist()) for i, v in enumerate(vectors(120, 7))]
    rows += rows[:9] + [(200 + i, rows[0][1]) for i in range(40)] + [(None, rows[1][1]), (None, rows[1][1])]  # copies, null keys
    rows += [(300, None), (301, []), (302, [None] * 7), (303, [1.0] * 6 + [float("nan")]), (304, [float("inf")] + [0.0] * 6), (305, [1.0, 2.0]), (306, [-0.0] * 7)]
    assert check(spark, rows)
    err = W.whiten(table(spark, rows)).select("identity_error").distinct().collect()
    assert len(err) == 1 and err[0][0] < 1e-12
    check(spark, rows, most=7)
    check(spark, rows, factor=16.0, most=2)


def test_few_vectors(spark):
    assert W.whiten(table(spark, [(1, [1.0, 2.0])])).count() == 0
    assert W.whiten(table(spark, [(1, [1.0, 2.0])] * 5)).count() == 0
    assert W.whiten(table(spark, [(1, None)])).count() == 0
    assert W.whiten(table(spark, [(1, [1.0])]).where("false")).count() == 0
    check(spark, [(1, [1.0, 2.0]), (2, [3.0, 2.5]), (2, [3.0, 2.5])])            # one component has variance
    check(spark, [(i, [float(i % 5)]) for i in range(20)])                        # one entry


def test_lengths_and_blocks(spark, monkeypatch):
    check(spark, [(i, [float(i), 1.0, float(i * i % 7)]) for i in range(9)] + [(50 + i, [float(i), 2.0 * i]) for i in range(9)])
    monkeypatch.setattr(W, "SIDE", 3)
    monkeypatch.setattr(W, "ROWS", 10)
    a = vectors(60, 8)
    fit = spark.createDataFrame([(np.floor(256 * v.astype(float)).astype(int).tolist(),) for v in a], "x array<long>")
    x = np.floor(256 * a.astype(float))
    mean = x.mean(0)
    side, rows = 3, 10

    def centred(y):
        return y - mean
    assert (side, rows) == (W.SIDE, W.ROWS)
    assert np.allclose(W._moments(fit, 8, centred), np.cov(x.T, bias=True))
    n, total = W._sums(fit, 8)
    assert n == 60 and total == x.sum(0).astype(int).tolist()


def test_deviations_are_exact():
    x = np.array([[1 << 30, -(1 << 30)], [3, 4]])
    assert W.deviations(x[1:], 10, [7, -7]).tolist() == [(30 - 7) ** 2 + (40 + 7) ** 2]
    assert W.deviations(x, 1, [1, 1]).tolist() == [((1 << 30) - 1) ** 2 + ((1 << 30) + 1) ** 2, 13]
    big = np.array([[1 << 31]])
    assert W.deviations(big, 1, [(1 << 31) - 3_000_000_000]).tolist() == [3_000_000_000 ** 2]
    with pytest.raises(OverflowError):
        W.deviations(big, 4, [0])
