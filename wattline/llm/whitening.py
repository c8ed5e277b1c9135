"""Whitening of embeddings by spectral divide and conquer.

The covariance of the distinct vectors is summed up on Spark; it is as large
as the vectors are long, whatever their number, and comes to the driver.
There it is split: the unitary polar factor of the covariance, shifted by its
mean eigenvalue, is its sign, so that (I + sign) / 2 projects onto the
eigenvectors above the shift.  QDWH iterations give the polar factor from QR
and Cholesky factorisations alone.  Each invariant subspace is split again
until it is one component.  The leading components are broadcast and every
row is projected where it lies.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm import shipped, tidy
from wattline.llm.exchange import stage

EPS = np.finfo(np.float64).eps
WIDEST = 4096  # longest vectors taken: the covariance on the driver is at most 128 MB
SIDE = 256     # rows of the covariance that one record carries at most
ROWS = 1 << 13  # vectors multiplied at once
SHIFTS = (0.0, 0.05, -0.05, 0.15, -0.15, 0.3, -0.3)  # tried around the mean eigenvalue, in spreads


# --- spectral divide and conquer, on matrices as wide as a vector is long ---------

def polar(a: np.ndarray) -> np.ndarray:
    """Unitary polar factor of a square matrix by QDWH: dynamically weighted Halley iterations,
    by QR while the smallest singular value may be tiny, by Cholesky afterwards."""
    n = len(a)
    x = a / max(np.linalg.norm(a), np.finfo(np.float64).tiny)
    r = np.abs(np.diag(np.linalg.qr(x, mode="r")))
    low = max(min(1.0, float(r.min()) / np.sqrt(n)) * 0.1, EPS)  # below the smallest singular value, as a rule
    eye = np.eye(n)
    for _ in range(40):
        d = np.cbrt(4.0 * (1.0 - low * low) / low**4)
        h = np.sqrt(1.0 + d) + 0.5 * np.sqrt(max(8.0 - 4.0 * d + 8.0 * (2.0 - low * low) / (low * low * np.sqrt(1.0 + d)), 0.0))
        b = (h - 1.0) ** 2 / 4.0
        c = h + b - 1.0
        if c > 100.0:
            q, _ = np.linalg.qr(np.concatenate([np.sqrt(c) * x, eye]))
            new = (b / c) * x + (h - b / c) / np.sqrt(c) * (q[:n] @ q[n:].T)
        else:
            w = np.linalg.cholesky(eye + c * (x.T @ x))
            half = np.linalg.solve(w, x.T)
            new = (b / c) * x + (h - b / c) * np.linalg.solve(w.T, half).T
        low = min(1.0, low * (h + b * low * low) / (1.0 + c * low * low))
        step = np.linalg.norm(new - x)
        x = new
        if abs(low - 1.0) < 10 * EPS and step < np.cbrt(5 * EPS):
            break
    return x


def split(a: np.ndarray) -> tuple[np.ndarray, int] | None:
    """Orthogonal basis whose first k columns span the eigenvectors of the symmetric ``a`` above a
    shift, and k; None where ``a`` is a multiple of the identity to rounding."""
    n = len(a)
    mean = np.trace(a) / n
    spread = np.linalg.norm(a - mean * np.eye(n)) / np.sqrt(n)
    if spread <= 4 * EPS * max(abs(mean), np.linalg.norm(a) / n):
        return None
    for move in SHIFTS:
        u = polar(a - (mean + move * spread) * np.eye(n))
        p = (np.eye(n) + (u + u.T) / 2.0) / 2.0
        k = int(round(np.trace(p)))
        if not 0 < k < n or np.linalg.norm(p @ p - p) > 1e-10 * n:
            continue  # an eigenvalue lies at the shift
        start = np.random.default_rng(n).standard_normal((n, n))
        up, down = np.linalg.qr(p @ start[:, :k])[0], np.linalg.qr(start[:, k:] - p @ start[:, k:])[0]
        up, down = np.linalg.qr(p @ up)[0], np.linalg.qr(down - p @ down)[0]
        q = np.linalg.qr(np.concatenate([up, down], axis=1))[0]
        if np.linalg.norm(q[:, k:].T @ a @ q[:, :k]) <= 1e-12 * np.sqrt(n) * np.linalg.norm(a):
            return q, k
    raise ArithmeticError("no shift parts the spectrum")


def components(a: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as columns) of the symmetric ``a``, by falling value, the first ``most``."""
    a = (a + a.T) / 2.0
    n = len(a)
    most = n if most is None else min(most, n)
    found, todo = [], [np.eye(n)]  # bases of invariant subspaces, from the upper end of the spectrum
    while todo and len(found) < most:
        basis = todo.pop()
        if basis.shape[1] == 1:
            found.append(basis)
            continue
        inner = basis.T @ a @ basis
        parted = split((inner + inner.T) / 2.0)
        if parted is None:  # equal eigenvalues: any basis of the subspace will do
            found += [basis[:, [i]] for i in range(basis.shape[1])]
            continue
        q, k = parted
        todo += [basis @ q[:, k:], basis @ q[:, :k]]
    vectors = np.concatenate(found, axis=1) if found else np.zeros((n, 0))
    vectors = np.linalg.qr(vectors)[0] if vectors.size else vectors  # subspaces split apart stay orthogonal to rounding
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")[:most]
    return values[order], vectors[:, order]


# --- sums on Spark ----------------------------------------------------------------

def whole_vectors(rows: DataFrame, key: str, column: str, factor: float) -> DataFrame:
    """``key`` and ``x``, floor(factor * entry) as long, of rows whose vector has finite entries only."""
    value = F.col(column).cast("array<double>")
    fine = rows.select(F.col(key).alias("_key"), value.alias("_v")).where(
        (F.size("_v") > 0) & F.forall("_v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    return fine.select("_key", F.transform("_v", lambda c: F.floor(F.lit(float(factor)) * c).cast("long")).alias("x"))


def _matrix(batch, dim: int) -> np.ndarray:
    return batch.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """(rows, sum of each entry), exact."""
    def run(batches):
        total, n = [0] * dim, 0
        for batch in batches:
            x = _matrix(batch.column(0), dim)
            n += len(x)
            low, high = (x & 0xFFFF).sum(axis=0), (x >> 16).sum(axis=0)  # halves do not overflow
            total = [t + int(a) + (int(b) << 16) for t, a, b in zip(total, low, high, strict=True)]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([[str(t) for t in total]], pa.list_(pa.string()))], names=["n", "total"])

    part = fit.select("x").mapInArrow(run, "n long, total array<string>")
    sums = part.select("n", F.posexplode("total").alias("i", "t")).groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("t").cast("decimal(38,0)")).alias("t"))
    got = sorted(sums.collect(), key=lambda r: r["i"])  # one row for each entry of a vector
    return int(got[0]["n"]), [int(r["t"]) for r in got]


def _moments(fit: DataFrame, dim: int, project) -> np.ndarray:
    """Mean over ``fit`` of outer products of what ``project`` makes of its vectors, whose width is its own."""
    def run(batches):
        total, n = None, 0
        for batch in batches:
            x = _matrix(batch.column(0), dim)
            for a in range(0, len(x), ROWS):
                y = project(x[a:a + ROWS])
                total = y.T @ y if total is None else total + y.T @ y
            n += len(x)
        if total is not None:
            for i in range(0, len(total), SIDE):
                for j in range(0, len(total), SIDE):
                    block = total[i:i + SIDE, j:j + SIDE]
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([n], pa.int64()),
                                                      pa.array([block.ravel()], pa.list_(pa.float64()))], names=["i", "j", "n", "block"])
        tidy()

    def add(key, group):
        group = group.combine_chunks()
        total = group["block"].combine_chunks().flatten().to_numpy().reshape(group.num_rows, -1).sum(axis=0)
        return pa.table({"i": pa.array([key[0].as_py()], pa.int32()), "j": pa.array([key[1].as_py()], pa.int32()),
                         "n": pa.array([int(group["n"].to_numpy().sum())], pa.int64()), "block": pa.array([total], pa.list_(pa.float64()))})

    schema = "i int, j int, n long, block array<double>"
    part = fit.select("x").mapInArrow(run, schema)
    blocks = part.groupBy("i", "j").applyInArrow(add, schema).collect()  # as large as one vector squared
    wide = max(r["i"] for r in blocks) + int(np.sqrt(len(max(blocks, key=lambda r: r["i"] + r["j"])["block"])))
    out = np.zeros((wide, wide))
    for r in blocks:
        i, j = r["i"], r["j"]
        out[i:i + SIDE, j:j + SIDE] = np.array(r["block"]).reshape(min(SIDE, wide - i), min(SIDE, wide - j))
    return out / blocks[0]["n"]


def whiten(rows: DataFrame, key: str = "vec_id", column: str = "embedding", factor: float = 256.0, most: int = 4) -> DataFrame:
    """key, component, n, deviation, whitened, explained, eigenvalue, identity_error.

    Each row is projected on the ``most`` leading components of the distinct
    vectors' covariance.  Null vectors, empty ones and those with a null,
    infinite or NaN entry take no part, nor do vectors of another length than
    most distinct ones have (of equally frequent lengths the longest counts);
    lengths up to ``WIDEST``.  Repeated rows and null keys are answered each.
    Components without variance (eigenvalue within rounding of 0) are left
    out, so that equal vectors, a single one or an empty table give no rows;
    of equal eigenvalues any basis is taken, the same for all rows.  A
    ``deviation`` beyond 64 bits raises; entries beyond them are set to their end.  Further columns are ignored,
    whatever their names."""
    spark = rows.sparkSession
    out = f"`{key}` {rows.schema[key].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, eigenvalue double, identity_error double"
    whole = whole_vectors(shipped(rows), key, column, factor)
    fit = stage(whole.select("x", F.size("x").alias("dim")).distinct())
    lengths = fit.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], out)
    dim = lengths[0]["dim"]
    if dim > WIDEST:
        raise ValueError(f"vectors of {dim} entries; {WIDEST} at most")
    fit = fit.where(F.col("dim") == dim)
    n, total = _sums(fit, dim)
    mean = np.array([t / n for t in total])  # quotients of integers, rounded once

    def centred(x):
        return x - mean

    covariance = _moments(fit, dim, centred)
    values, vectors = components(covariance, most)
    trace = float(np.trace(covariance))
    real = values > dim * EPS * max(float(values[0]) if len(values) else 0.0, 0.0)
    values, vectors = values[real], vectors[:, real]
    if not len(values):
        return spark.createDataFrame([], out)
    scaled = vectors / np.sqrt(values)

    def whitened(x):
        return (x - mean) @ scaled

    identity = _moments(fit, dim, whitened)  # their mean is 0 as that of x - S/n is
    error = float(np.abs(identity - np.eye(len(values))).max())
    model = spark.sparkContext.broadcast((n, total, mean, scaled, values, trace, error))  # as large as ``most`` vectors

    def project(batches):
        n, total, mean, scaled, values, trace, error = model.value
        k = len(values)
        for batch in batches:
            x = _matrix(batch.column(1), len(mean))
            for a in range(0, len(x), ROWS):
                some = x[a:a + ROWS]
                m = len(some)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, m).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * k, n)), pa.array(np.repeat(deviations(some, n, total), k)),
                     pa.array(((some - mean) @ scaled).ravel()), pa.array(np.tile(values / trace, m)),
                     pa.array(np.tile(values, m)), pa.array(np.full(m * k, error))],
                    names=[key, "component", "n", "deviation", "whitened", "explained", "eigenvalue", "identity_error"])

    return whole.where(F.size("x") == dim).mapInArrow(project, out)


def deviations(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """Sum over entries of (n * x - total)**2, exact; raises beyond 64 bits."""
    reach = n * int(np.abs(x).max(initial=0)) + max(map(abs, total), default=0)
    if reach * reach * x.shape[1] < 1 << 63:
        gap = n * x - np.array(total, np.int64)
        return np.einsum("ij,ij->i", gap, gap)
    out = [sum((n * int(v) - t) ** 2 for v, t in zip(row, total, strict=True)) for row in x]
    if max(out) >= 1 << 63:
        raise OverflowError("a deviation beyond 64 bits")
    return np.array(out, np.int64)
