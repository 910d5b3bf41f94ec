"""Embedding whitening by a block Jacobi-Davidson method.

Entries become whole numbers, so that the fit list (each distinct vector
once), its size, sums and deviations are exact. The covariance is never
formed: Spark multiplies it with a block of vectors, each task its rows
centred, and sums the tasks' products. The leading eigenvectors come from
Rayleigh-Ritz over a subspace that grows by corrections: for each wanted pair
that has not converged, the equation projected off the locked and current
vectors is solved by MINRES, all of a round in step, so that one pass over
the data serves the whole block. Converged pairs are locked from the top
until every residual is at double precision. The driver holds the subspace
only, at most ``SUBSPACE`` vectors; a task holds a batch.

Edge cases: vectors that are null, empty, or hold null or non-finite entries
or ones of 2**46 and more are dropped, and so are those of another length than
most have; equal rows are fitted once and all returned; null ids stay;
components without variance (fewer distinct vectors than components, or
constant ones) are left out; a deviation beyond a long is null; an empty table
gives an empty table; only the id and vector columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import materialize

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
#: Vectors kept by the driver, at most; more are cut back to the leading ones.
SUBSPACE = 96
#: MINRES steps of one correction, and rounds before the method gives up.
STEPS, ROUNDS = 6, 200

Product = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Whitener:
    """Exact centre (``sums`` over ``n``), unit eigenvectors as columns, their eigenvalues and the trace."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float = float("nan")


def orthonormal(block: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """The block's directions off ``against``, those that vanish left out."""
    kept = np.zeros((len(block), 0))
    for v in block.T:
        size = np.linalg.norm(v)
        if not size:
            continue
        v = v / size
        for _ in range(3):
            for base in (*against, kept):
                v = v - base @ (base.T @ v)
            rest = np.linalg.norm(v)
            if rest < 1e-10:
                break
            v = v / rest
        else:
            kept = np.column_stack([kept, v])
    return kept


def corrections(times: Product, off: np.ndarray, shifts: np.ndarray, r: np.ndarray, steps: int, tol: float) -> np.ndarray:
    """MINRES for (A - shift) t = -r in the space off ``off``, one column per equation, in step.

    A step is one product with the block of Lanczos vectors.
    """
    project = lambda x: x - off @ (off.T @ x)
    k = r.shape[1]
    v_old, v = np.zeros_like(r), project(-r)
    beta = np.linalg.norm(v, axis=0)
    start = np.where(beta > 0, beta, 1)
    eta, c_old, c, s_old, s = beta.copy(), np.ones(k), np.ones(k), np.zeros(k), np.zeros(k)
    w_old, w, x = np.zeros_like(r), np.zeros_like(r), np.zeros_like(r)
    v, live, beta = v / start, beta > 0, np.zeros(k)
    for _ in range(steps):
        if not live.any():
            break
        p = project(times(v) - v * shifts)
        alpha = (v * p).sum(0)
        new = project(p - v * alpha - v_old * beta)
        beta_new = np.linalg.norm(new, axis=0)
        delta = c * alpha - c_old * s * beta
        rho1, rho2, rho3 = np.hypot(delta, beta_new), s * alpha + c_old * c * beta, s_old * beta
        live &= rho1 > 0
        rho = np.where(rho1 > 0, rho1, 1)
        c_new, s_new = delta / rho, beta_new / rho
        w_new = (v - w_old * rho3 - w * rho2) / rho
        x = x + np.where(live, c_new * eta, 0) * w_new
        eta = np.where(live, -s_new * eta, eta)
        live &= (beta_new > 1e-14 * start) & (np.abs(eta) > tol * start)
        v_old, v, w_old, w = v, new / np.where(beta_new > 0, beta_new, 1), w, w_new
        beta, c_old, c, s_old, s = beta_new, c, c_new, s, s_new
    return x


def leading_pairs(times: Product, d: int, k: int, seed: int = 7, subspace: int = SUBSPACE, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their vectors, of a positive semidefinite matrix given by its product.

    Raises if ``ROUNDS`` rounds do not bring every residual to double precision.
    """
    k = min(k, d)
    most = max(subspace, 3 * k)
    locked = np.zeros((d, 0))
    space = orthonormal(np.random.default_rng(seed).standard_normal((d, min(d, k + k // 2))))
    image, scale = times(space), 0.0
    for turn in range(ROUNDS):
        h = space.T @ image
        values, mix = np.linalg.eigh((h + h.T) / 2)
        values, mix = values[::-1], mix[:, ::-1]
        space, image = space @ mix, image @ mix
        want = k - locked.shape[1]
        r = image[:, :want] - space[:, :want] * values[:want]
        r -= locked @ (locked.T @ r)
        scale = max(scale, values[0])
        size = np.linalg.norm(r, axis=0)
        full = locked.shape[1] + space.shape[1] >= d
        good = (size <= precision(d) * scale) | full
        done = int(np.argmin(good)) if not good.all() else want  # from the top
        if done:
            locked = np.column_stack([locked, space[:, :done]])
            space, image = space[:, done:], image[:, done:]
            if locked.shape[1] == k:
                return ritz(times, locked)
            r, values, size = r[:, done:], values[done:], size[done:]
        want = k - locked.shape[1]
        off = np.column_stack([locked, space[:, :want]])
        r, shifts = r[:, :want], values[:want]
        t = corrections(times, off, shifts, r, steps, 0.5 ** (turn + 1))
        if space.shape[1] + want > most:
            space, image = space[:, : want + k], image[:, : want + k]
        new = orthonormal(t, locked, space)
        if not new.shape[1]:  # corrections that add nothing: go on from other directions
            new = orthonormal(np.random.default_rng([seed, turn]).standard_normal((d, want)), locked, space)
        space = np.column_stack([space, new])
        image = np.column_stack([image, times(new)])
    raise RuntimeError(f"{k - locked.shape[1]} of {k} eigenvectors did not converge in {ROUNDS} rounds")


def precision(d: int) -> float:
    """The residual, over the largest eigenvalue, that counts as rounding."""
    return 16 * np.sqrt(d) * np.finfo(float).eps


def ritz(times: Product, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values and vectors of the space that the vectors span, falling, each vector's largest entry positive."""
    q = np.linalg.qr(vectors)[0]
    h = q.T @ times(q)
    values, mix = np.linalg.eigh((h + h.T) / 2)
    out = q @ mix[:, ::-1]
    out *= np.sign(out[np.abs(out).argmax(0), np.arange(out.shape[1])])
    return values[::-1], out


# On Spark.


def whole_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows (id, x) of the vectors that count."""
    c = F.col(vector_col).cast("array<double>")
    fine = F.forall("c", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float(1 << 46)))
    rows = df.select(F.col(id_col).alias("id"), c.alias("c")).filter(F.coalesce(fine, F.lit(False)) & (F.size("c") > 0))
    return rows.select("id", F.transform("c", lambda e: F.floor(e * SCALE) + SHIFT).alias("x"))


def _matrix(b: pa.RecordBatch, column: int, d: int) -> np.ndarray:
    return b.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _summed(fit: DataFrame, d: int, width: int, part: Callable[[np.ndarray], np.ndarray], kind: str, rows: int | None = None) -> np.ndarray:
    """The sum over all vectors of ``part`` of a batch's, an array of ``rows`` (or ``d``) by ``width``.

    Tasks give their sums by row; these are grouped by row, so only the
    result reaches the driver.
    """
    names = [f"c{k}" for k in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                own = part(_matrix(b, 0, d))
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), *map(pa.array, total.T)], ["place", *names])

    tasks = fit.select("x").mapInArrow(run, ", ".join(["place int", *(f"{c} {kind}" for c in names)]))
    found = tasks.groupBy("place").agg(*[F.sum(c).alias(c) for c in names]).collect()  # ``rows`` or ``d`` rows
    out = np.zeros((rows or d, width), np.int64 if kind == "long" else float)
    for r in found:
        out[r[0]] = r[1:]
    return out


def fit_whitener(fit: DataFrame, d: int, components: int = COMPONENTS) -> Whitener | None:
    """From the distinct vectors ``x`` of length ``d``; None without any."""
    first = _summed(fit, d, 2, lambda x: np.column_stack([x.sum(0), np.full(x.shape[1], len(x))]), "long")
    sums, n = first[:, 0], int(first[0, 1])
    if not n:
        return None

    def centred(x: np.ndarray) -> np.ndarray:
        return (n * x - sums) / n

    def times(block: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            y = centred(x)
            return y.T @ (y @ block)

        return _summed(fit, d, block.shape[1], part, "double") / n

    squares = _summed(fit, d, 1, lambda x: (centred(x) ** 2).sum(0)[:, None], "double")
    trace = float(squares.sum() / n)
    if not trace:
        return Whitener(n, sums, np.zeros((d, 0)), np.zeros(0), trace, 0.0)
    values, vectors = leading_pairs(times, d, components)
    there = values > precision(d) * values[0]
    values, vectors = values[there], vectors[:, there]
    scaled, k = vectors / np.sqrt(values), len(values)

    def squared(x: np.ndarray) -> np.ndarray:
        z = centred(x) @ scaled
        return np.vstack([z.T @ z, z.sum(0)])

    second = _summed(fit, d, k, squared, "double", k + 1) / n
    error = np.abs(second[:k] - np.outer(second[k], second[k]) - np.eye(k)).max()
    return Whitener(n, sums, vectors, values, trace, float(error))


def whiten(df: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, Whitener | None]:
    """Rows (id, deviation, whitened) of the vectors that count, and the fit.

    ``whitened`` has one entry per component, by falling eigenvalue.
    """
    rows = whole_vectors(df, id_col, vector_col)
    schema = T.StructType([rows.schema["id"]]).add("deviation", "long").add("whitened", T.ArrayType(T.DoubleType()))
    length = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if length is None:
        return df.sparkSession.createDataFrame([], schema), None
    d = length.d
    rows = rows.filter(F.size("x") == d)
    w = fit_whitener(materialize(rows.select("x").distinct(), "fit"), d, components)
    scaled, n, sums = w.vectors / np.sqrt(w.values), w.n, w.sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            far = n * _matrix(b, 1, d) - sums
            deviation, wide = (far * far).sum(1), (far.astype(float) ** 2).sum(1) > 9e18
            known = [not w or sum(int(v) ** 2 for v in row) < 1 << 63 for row, w in zip(far, wide)]
            z = (far / n) @ scaled
            ends = np.arange(len(z) + 1, dtype=np.int32) * z.shape[1]
            columns = [b.column(0), pa.array(deviation, mask=~np.array(known, bool)), pa.ListArray.from_arrays(ends, z.ravel())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(run, schema), w


def op12_jacobi_davidson_whitening(spark, sf_dir: str) -> DataFrame:
    found, w = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    explained = [float(v / w.trace) for v in w.values] if w else []
    each = found.select(F.col("id").alias("vec_id"), "deviation", F.posexplode("whitened").alias("at", "whitened"))
    shares = F.array(*map(F.lit, explained)).cast("array<double>")
    return each.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(w.n if w else 0).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.try_element_at(shares, F.col("at") + 1).alias("explained"),
        F.lit(w.identity_error if w else 0.0).alias("identity_error"),
    )
