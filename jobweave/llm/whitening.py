"""Whitening of embeddings along their principal components.

The components are the leading eigenvectors of the covariance V of the *fit list*, every distinct
quantised vector once.  V is never formed: each product V Y with a block of vectors Y is one
Spark job, in which tasks multiply their centred rows, and partial sums are added by row of the
product.  The driver holds blocks of as many numbers as a vector has, times ``MAX_BASIS``.

The eigenvectors come from a block Jacobi-Davidson method.  Rayleigh-Ritz in a search space gives
approximations; each of the leading ones gets a correction from

    (I - Z Z') (V - theta I) (I - Z Z') t = -r,      r = V u - theta u,

with Z the pairs found so far and the block's approximations, solved by ``INNER`` steps of
MINRES for all of the block at once, so that a step costs one product.  The corrections widen
the search space.  Pairs are locked from the largest eigenvalue down when their residuals reach
double precision, ``4 eps trace(V)``, and the rest of the space is kept orthogonal to them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobweave.llm.common import cut_lineage, rows_of

COMPONENTS = 16
#: A component c of a vector becomes floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
INNER = 4
#: Vectors that the search space has at most, as a multiple of the components sought.
MAX_BASIS = 6
#: Rounds that may pass until the first residual has halved, and the share of the trace below
#: which rounding is taken to be the reason if it hasn't.
PATIENCE, _ROUNDED = 25, 1e-11
_EPS = float(np.finfo(float).eps)

Product = Callable[[np.ndarray], np.ndarray]


def quantised(vector: Column) -> Column:
    """Whole numbers for a vector; null where the vector is, or holds a null or non-finite number."""
    v = vector.cast("array<double>")
    broken = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.when(~F.coalesce(broken, F.lit(True)), F.transform(v, lambda c: F.floor(c * SCALE).cast("long") + OFFSET))


def _matrix(batch: pa.RecordBatch, name: str, d: int) -> np.ndarray:
    flat = batch.column(batch.schema.get_field_index(name)).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, d)


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n x - S, exact: 64-bit numbers, or Python's where these don't hold the squares' sums."""
    most = n * max(float(np.abs(x).max(initial=0)), float(max((abs(int(s)) for s in sums), default=0)) / max(n, 1))
    spread = float(np.abs(x * float(n) - sums.astype(float)).max(initial=0)) + 1
    if most < 2**61 and x.shape[1] * spread * spread < 2**61:
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums


class Sum:
    """A running sum of arrays that keeps what rounding drops."""

    def __init__(self, shape: tuple[int, ...]) -> None:
        self.total, self.lost = np.zeros(shape), np.zeros(shape)

    def add(self, x: np.ndarray) -> None:
        total = self.total + x
        self.lost += np.where(np.abs(self.total) >= np.abs(x), (self.total - total) + x, (x - total) + self.total)
        self.total = total


def _summed(fit: DataFrame, n: int, sums: np.ndarray, rows: int, columns: int, term: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over the fit list of ``term``, (rows x columns) of a batch's centred vectors."""
    d, names = len(sums), [f"c{i}" for i in range(columns)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Sum((rows, columns))
        for batch in rows_of(batches):
            total.add(term(deviations(_matrix(batch, "x", d), n, sums).astype(float) / n))
        part = total.total + total.lost
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(rows, dtype=np.int32)), *(pa.array(part[:, i]) for i in range(columns))], ["at", *names])

    made = fit.mapInArrow(run, ", ".join(["at int", *(f"{c} double" for c in names)]))
    out = np.zeros((rows, columns))
    for row in made.groupBy("at").agg(*[F.sum(c).alias(c) for c in names]).collect():
        out[row["at"]] = row[1:]
    return out


def minres(product: Product, theta: np.ndarray, z: np.ndarray, rhs: np.ndarray, steps: int) -> np.ndarray:
    """A column of approximate solutions for every column of ``rhs``, by MINRES in lockstep."""
    project = lambda y: y - z @ (z.T @ y)
    x, w, w_old, v_old = (np.zeros_like(rhs) for _ in range(4))
    v = project(rhs)
    beta = np.linalg.norm(v, axis=0)
    eta, cos, cos_old, sin, sin_old = beta.copy(), np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    over = lambda a, b: np.divide(a, b, out=np.zeros(np.broadcast_shapes(np.shape(a), np.shape(b))), where=b > 0)
    for _ in range(steps):
        v = over(v, beta)
        y = project(product(v) - v * theta)
        alpha = (v * y).sum(axis=0)
        y = project(y - v * alpha - v_old * beta)
        beta_next = np.linalg.norm(y, axis=0)
        diagonal = cos * alpha - cos_old * sin * beta
        size = np.hypot(diagonal, beta_next)
        w, w_old = over(v - w_old * (sin_old * beta) - w * (sin * alpha + cos_old * cos * beta), size), w
        cos_old, sin_old, cos, sin = cos, sin, over(diagonal, size), over(beta_next, size)
        x += w * (cos * eta)
        eta = -sin * eta
        v_old, v, beta = v, y, beta_next
    return x


def orthonormal(y: np.ndarray, against: np.ndarray) -> np.ndarray:
    """Orthonormal columns for what of ``y`` is independent of ``against``'s and each other."""
    kept = [c for c in against.T]
    for column in y.T:
        size = np.linalg.norm(column)
        for _ in range(3):
            if not size:
                break
            column = column / size
            if kept:
                q = np.array(kept)
                column = column - q.T @ (q @ column)
            left = np.linalg.norm(column)
            if left > 0.5:  # nothing was lost to cancellation
                kept.append(column / left)
                break
            size = left if left > 1e-8 else 0.0
    return np.array(kept[against.shape[1] :]).reshape(-1, y.shape[0]).T


def jacobi_davidson(product: Product, d: int, k: int, trace: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, their unit eigenvectors as columns, and their residuals."""
    rng = np.random.default_rng(17)
    locked, tolerance, largest = np.zeros((d, 0)), 4 * _EPS * trace, min(d, MAX_BASIS * k)
    basis = orthonormal(rng.normal(size=(d, min(d, 2 * k))), locked)
    image, best, idle = product(basis), np.inf, 0
    while locked.shape[1] < k:
        theta, turn = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        wanted = min(k - locked.shape[1], basis.shape[1])
        residual = image[:, :wanted] - basis[:, :wanted] * theta[:wanted]
        residual -= locked @ (locked.T @ residual)
        norms = np.linalg.norm(residual, axis=0)
        whole = basis.shape[1] + locked.shape[1] >= d  # nothing left to search
        done = wanted if whole else int(np.argmax(np.append(norms > tolerance, True)))
        if not done and idle >= PATIENCE:  # rounding keeps the first pair from getting better
            if norms[0] > _ROUNDED * trace:
                raise ArithmeticError(f"no convergence: a residual of {norms[0]:g} stays, the trace is {trace:g}")
            done = 1
        idle = 0 if norms[min(done, wanted - 1)] < best / 2 or done else idle + 1
        best = np.inf if done else min(best, norms[0])
        if done:
            locked = np.concatenate([locked, basis[:, :done]], axis=1)
            basis, image, residual, theta = basis[:, done:], image[:, done:], residual[:, done:], theta[done:]
            if locked.shape[1] >= k:
                break
        if basis.shape[1] + residual.shape[1] > largest:
            keep = max(residual.shape[1], min(2 * k, largest - residual.shape[1]))
            basis, image = basis[:, :keep], image[:, :keep]
        width = residual.shape[1]
        z = np.concatenate([locked, basis[:, :width]], axis=1)
        steps = minres(product, theta[:width], z, -residual, INNER)
        new = orthonormal(steps, np.concatenate([locked, basis], axis=1))
        if not new.shape[1]:  # no correction points anywhere new
            new = orthonormal(rng.normal(size=(d, 1)), np.concatenate([locked, basis], axis=1))
        basis, image = np.concatenate([basis, new], axis=1), np.concatenate([image, product(new)], axis=1)
    image = product(locked)
    theta, turn = np.linalg.eigh((locked.T @ image + image.T @ locked) / 2)
    theta, turn = theta[::-1], turn[:, ::-1]
    vectors, image = locked @ turn, image @ turn
    vectors /= np.linalg.norm(vectors, axis=0)
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return theta, vectors * signs, np.linalg.norm(image - vectors * theta, axis=0)


@dataclass
class Whitening:
    """Size, sums and leading components of a fit list; ``residuals`` are those of V u = e u."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    trace: float
    identity_error: float | None = None

    def scales(self) -> np.ndarray:
        """What projections are divided by; infinite where an eigenvalue is zero to double precision."""
        return np.where(self.values > 4 * _EPS * self.trace, np.sqrt(np.maximum(self.values, 0)), np.inf)

    def explained(self) -> list[float | None]:
        return [max(float(e), 0.0) / self.trace if self.trace else None for e in self.values]


def _padded(df: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """``df`` and a column ``_x`` of quantised vectors of one length, and that length."""
    rows = df.withColumn("_x", quantised(F.col(f"`{vector}`")))
    least, most = rows.agg(F.min(F.size("_x")), F.max(F.size("_x"))).first()
    if least != most:
        rows = rows.withColumn("_x", F.when(F.col("_x").isNotNull(), F.concat("_x", F.array_repeat(F.lit(OFFSET).cast("long"), F.lit(most) - F.size("_x")))))
    return rows, max(most or 0, 0)


def fit(df: DataFrame, vector: str = "embedding", k: int = COMPONENTS) -> Whitening | None:
    """Components of the distinct vectors of ``df``; None if it has no usable vector.

    Vectors that are null, or hold null or non-finite numbers, take no part; a shorter vector
    counts as one that ends in zeros.  There are as many components as numbers in a vector, at
    most ``k``.
    """
    rows, d = _padded(df.select(F.col(f"`{vector}`").alias("v")), "v")
    if not d:
        return None
    distinct = cut_lineage(rows.where("_x is not null").select(F.col("_x").alias("x")).distinct(), "fit-list")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            x = _matrix(batch, "x", d)
            total = x.sum(axis=0) if float(np.abs(x).max()) * len(x) < 2**62 else x.astype(object).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), pa.array([str(s) for s in total]), pa.array([len(x)] * d)], ["at", "s", "n"])

    parts = distinct.mapInArrow(run, "at int, s string, n long").groupBy("at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
    sums, n = np.zeros(d, dtype=object), 0
    for row in parts.collect():
        sums[row["at"]], n = int(row["s"]), row["n"]

    trace = float(_summed(distinct, n, sums, d, 1, lambda c: (c * c).sum(axis=0)[:, None]).sum()) / n
    product = lambda y: _summed(distinct, n, sums, d, y.shape[1], lambda c: c.T @ (c @ y)) / n
    found = Whitening(n, sums, *jacobi_davidson(product, d, min(k, d), trace), trace)
    use = np.isfinite(found.scales())
    if use.any():
        p = found.vectors[:, use] / found.scales()[use]
        m = p.shape[1]
        mean = _summed(distinct, n, sums, m, 1, lambda c: (c @ p).sum(axis=0)[:, None])[:, 0] / n
        covariance = _summed(distinct, n, sums, m, m, lambda c: (c @ p - mean).T @ (c @ p - mean)) / n
        found.identity_error = float(np.abs(covariance - np.eye(m)).max())
    return found


def _whitened_rows(model: Whitening, names: list[str]):
    d, scales = len(model.sums), model.scales()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            at = batch.schema.get_field_index("_x")
            there = np.flatnonzero(batch.column(at).is_valid().to_numpy(zero_copy_only=False))
            exact = deviations(_matrix(batch.take(pa.array(there)), "_x", d), model.n, model.sums)
            squares, out = (exact * exact).sum(axis=1), (exact.astype(float) / model.n) @ model.vectors / scales
            deviation, whitened = [None] * batch.num_rows, [None] * batch.num_rows
            for i, s, w in zip(there, squares, out):
                deviation[i] = int(s) if s < 2**63 else None
                whitened[i] = [float(v) if np.isfinite(r) else None for v, r in zip(w, scales)]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(deviation, pa.int64()), pa.array(whitened, pa.list_(pa.float64()))], [*names, "deviation", "whitened"])

    return run


def with_whitened(df: DataFrame, model: Whitening, vector: str = "embedding") -> DataFrame:
    """``df`` with ``deviation`` and ``whitened`` in place of any columns so named.

    ``deviation`` is the sum of (n x - S)^2, null where 64 bits don't hold it; ``whitened`` has a
    number for each component, null where the component has no variance.  Both are null for
    vectors that take no part.  Repeated rows stay; numbers past the fit list's length are left out.
    """
    d, names = len(model.sums), [c for c in df.columns if c not in ("deviation", "whitened")]
    x = quantised(F.col(f"`{vector}`"))
    x = F.when(x.isNotNull(), F.slice(F.concat(x, F.array_repeat(F.lit(OFFSET).cast("long"), d)), 1, d))
    schema = df.select(*[F.col(f"`{c}`") for c in names]).schema.add("deviation", "long").add("whitened", T.ArrayType(T.DoubleType()))
    return df.select(*[F.col(f"`{c}`") for c in names], x.alias("_x")).mapInArrow(_whitened_rows(model, names), schema)


SCHEMA = "vec_id {id}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def components(df: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", k: int = COMPONENTS) -> DataFrame:
    """A row for each usable vector and component, numbered from 1 by falling eigenvalue."""
    model = fit(df, vector, k)
    if model is None:
        return df.sparkSession.createDataFrame([], SCHEMA.format(id=df.schema[vec_id].dataType.simpleString()))
    slim = df.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{vector}`").alias("v"))
    rows = with_whitened(slim, model, "v").where("whitened is not null")
    rows = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    share = F.array(*[F.lit(e).cast("double") for e in model.explained()])
    return rows.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("at")).alias("explained"), F.lit(model.identity_error).cast("double").alias("identity_error"),
    )
