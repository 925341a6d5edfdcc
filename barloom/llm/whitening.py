"""Whitening of vectors: principal components of their covariance, each scaled to unit variance.

Entries become whole numbers first, so sums and products are exact: tasks reduce their rows to sums per dimension,
then to products of entries centred by the rounded mean, and Spark adds these up. What passes the driver is one
d x d matrix, whatever the number of rows.

The scatter is factored by pivoted Cholesky, P'AP = LL' (the next pivot is the largest diagonal left, so a matrix of
lower rank ends early), and one-sided Jacobi turns the columns of L until they are orthogonal. Their squared norms are
then the eigenvalues and the normalised columns the eigenvectors: small eigenvalues keep the accuracy of the factor, which squaring
it again would lose.

Defined cases: rows whose vector is null or empty, holds null or non-finite entries or entries beyond 2**40 are dropped, and so are those
of another length than most (ties: the longest); null and repeated ids stay, one set of rows each; components without variance (fewer
than ``components`` distinct directions, a single row, equal rows) are left out, as they cannot be scaled; equal
eigenvalues come in the order of the rotations, and a component's largest entry is positive (the first one of equals); an empty table gives
no rows; only ``keep`` columns are carried, so others may have any names.
"""
from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import stage

# Entries per unit, shift of the whole numbers, components asked for.
SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
LARGEST = float(1 << 40)  # of an entry: sums of its whole number stay exact
MOST_DIMENSIONS = 4_096  # the driver factors one matrix of that side
ROWS_PER_PRODUCT = 4_096


def whole_vectors(df: DataFrame, keep: Sequence[str], vector: str = "embedding") -> DataFrame:
    """``_row`` (the ``keep`` columns) and ``x``, the vector in whole numbers, of the rows that can be used."""
    entry = lambda c: c.isNotNull() & (F.abs(c.cast("double")) <= LARGEST)  # NaN is larger than any number
    usable = (F.coalesce(F.size(vector), F.lit(0)) > 0) & F.forall(vector, lambda c: F.coalesce(entry(c), F.lit(False)))
    whole = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + SHIFT)
    found = df.where(usable).select(F.struct(*keep).alias("_row"), whole.alias("x"))
    most = found.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return found.where(F.size("x") == most["d"]) if most else found


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _centred_products(z: np.ndarray) -> np.ndarray:
    """z'z of whole numbers, exactly: by doubles where these hold every sum, else by Python's integers."""
    most = int(np.abs(z).max(initial=0))
    if most * most * len(z) < 1 << 53:
        real = z.astype(np.float64)
        return (real.T @ real).astype(np.int64).astype(object)
    big = z.astype(object)
    return big.T @ big


def _summed(rows: DataFrame, centre: list[int] | None) -> dict[tuple[int, int], int]:
    """Sums of entries (``centre`` None: keys (-1, j)) or of products of centred entries (keys i <= j), and the rows under (-1, -1)."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        middle = None if centre is None else np.array(centre, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x"))
            for start in range(0, len(x), ROWS_PER_PRODUCT):
                part = x[start:start + ROWS_PER_PRODUCT]
                n += len(part)
                add = part.sum(axis=0).astype(object) if centre is None else _centred_products(part - middle)
                total = add if total is None else total + add
        if total is None:
            return
        if centre is None:
            keys = [(-1, -1), *((-1, j) for j in range(len(total)))]
            sums = [n, *total.tolist()]
        else:
            i, j = np.triu_indices(len(total))
            keys, sums = list(zip(i.tolist(), j.tolist())), total[i, j].tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array([str(s) for s in sums], pa.string())], names=["i", "j", "s"])

    parts = rows.select("x").mapInArrow(partial, "i int, j int, s string")
    summed = parts.groupBy("i", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    return {(r["i"], r["j"]): int(r["s"]) for r in summed.toLocalIterator()}


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """L (rows in the order of ``a``, one column per pivot) with L L' = a, for a symmetric matrix without negative eigenvalues.

    Differences of diagonals lose digits, so these steps use the long doubles the platform has; pivots below double precision end it.
    """
    d = len(a)
    a = a.astype(np.longdouble)
    rest = np.array(np.diag(a))
    done = np.zeros(d, bool)
    factor = np.zeros((d, d), np.longdouble)
    floor = d * np.finfo(float).eps * rest.max(initial=0.0)
    for k in range(d):
        p = int(np.argmax(np.where(done, -np.inf, rest)))
        if rest[p] <= floor:
            return factor[:, :k].astype(float)
        root = np.sqrt(rest[p])
        column = (a[:, p] - factor[:, :k] @ factor[p, :k]) / root
        column[done], column[p] = 0.0, root
        factor[:, k] = column
        done[p] = True
        rest -= column * column
    return factor.astype(float)


def one_sided_jacobi(factor: np.ndarray, most_sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and eigenvectors (columns) of factor factor', by rotating pairs of columns until all are orthogonal."""
    u = factor[:, np.argsort(-np.einsum("ij,ij->j", factor, factor), kind="stable")].copy()
    r = u.shape[1]
    ring = list(range(r + r % 2))  # a tournament: every column meets every other one once a sweep; an odd one out rests
    tolerance = np.finfo(float).eps
    for _ in range(most_sweeps):
        turned = False
        for _ in range(len(ring) - 1):
            half = len(ring) // 2
            met = [(min(a, b), max(a, b)) for a, b in zip(ring[:half], reversed(ring[half:])) if max(a, b) < r]
            ring = [ring[0], ring[-1], *ring[1:-1]]
            if not met:
                continue
            p, q = map(np.array, zip(*met))
            left, right = u[:, p], u[:, q]
            alpha, beta = np.einsum("ij,ij->j", left, left), np.einsum("ij,ij->j", right, right)
            gamma = np.einsum("ij,ij->j", left, right)
            off = np.abs(gamma) > tolerance * np.sqrt(alpha * beta)
            swap = beta > alpha
            if not (off | swap).any():
                continue
            turned = turned or bool(off.any())
            with np.errstate(divide="ignore", invalid="ignore"):
                zeta = (beta - alpha) / (2.0 * gamma)
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            t = np.where(off, t, 0.0)
            c = 1.0 / np.hypot(1.0, t)
            s = c * t
            first, second = c * left - s * right, s * left + c * right
            larger = np.einsum("ij,ij->j", second, second) > np.einsum("ij,ij->j", first, first)
            u[:, p], u[:, q] = np.where(larger, second, first), np.where(larger, first, second)
        if not turned:
            break
    norms = np.sqrt(np.einsum("ij,ij->j", u, u))
    if not r:
        return norms, u
    order = np.argsort(-norms, kind="stable")
    order = order[norms[order] > 0]
    vectors = u[:, order] / norms[order]
    signs = np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(vectors.shape[1])])
    return norms[order] ** 2, vectors * signs


@dataclass(frozen=True)
class Whitening:
    """A fitted model; ``centre`` is the rounded mean and ``residue`` what the mean has beyond it."""

    n: int
    sums: tuple[int, ...]
    centre: tuple[int, ...]
    residue: tuple[float, ...]
    values: tuple[float, ...]  # eigenvalues of the components kept
    vectors: tuple[tuple[float, ...], ...]  # one per component
    trace: float


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Components of the covariance (divisor n) of ``x`` over all rows; None without rows."""
    sums = _summed(rows, None)
    if not sums:
        return None
    n, d = sums.pop((-1, -1)), len(sums)
    if d > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {d} entries; at most {MOST_DIMENSIONS}")
    total = [sums[-1, j] for j in range(d)]
    centre = [(2 * s + n) // (2 * n) for s in total]
    beyond = [s - n * c for s, c in zip(total, centre)]
    products = _summed(rows, centre) if d else {}
    covariance = np.zeros((d, d), np.longdouble)
    exact_trace = Fraction(0)
    for (i, j), product in products.items():
        value = Fraction(n * product - beyond[i] * beyond[j], n * n)
        covariance[i, j] = covariance[j, i] = np.longdouble(value.numerator) / np.longdouble(value.denominator)
        exact_trace += value if i == j else 0
    values, vectors = one_sided_jacobi(pivoted_cholesky(covariance))
    kept = min(components, len(values))
    return Whitening(
        n, tuple(total), tuple(centre), tuple(b / n for b in beyond), tuple(values[:kept].tolist()),
        tuple(tuple(v) for v in vectors.T[:kept].tolist()), float(exact_trace),
    )


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """``_row``, the exact ``deviation`` (sum over dimensions of (n x - S)^2, decimal) and ``whitened``, one number per component."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, residue = np.array(model.centre, np.int64), np.array(model.residue)
        beyond = np.array(model.sums, object) - model.n * np.array(model.centre, object)
        scaled = np.array(model.vectors).T / np.sqrt(np.array(model.values))
        square_beyond = int((beyond * beyond).sum())
        most_beyond = max((abs(int(b)) for b in beyond), default=0)
        for batch in batches:
            if not batch.num_rows:
                continue
            z = _matrix(batch.column("x")) - centre
            # (n z - r)^2 = n^2 z^2 - 2 n z r + r^2 by dimension, with r = S - n centre
            most = int(np.abs(z).max(initial=0))
            if most * max(most, most_beyond, 1) * max(z.shape[1], 1) < 1 << 62:
                squares, crossed = (z * z).sum(axis=1).tolist(), (z @ beyond.astype(np.int64)).tolist()
            else:
                big = z.astype(object)
                squares, crossed = (big * big).sum(axis=1).tolist(), (big @ beyond).tolist()
            deviation = [str(model.n * model.n * a - 2 * model.n * b + square_beyond) for a, b in zip(squares, crossed)]
            found = (z - residue) @ scaled
            flat = pa.array(found.reshape(-1))
            ends = pa.array(np.arange(len(z) + 1) * scaled.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(deviation, pa.string()), pa.ListArray.from_arrays(ends, flat)],
                names=["_row", "deviation", "whitened"])

    schema = T.StructType([
        T.StructField("_row", rows.schema["_row"].dataType), T.StructField("deviation", T.StringType()),
        T.StructField("whitened", T.ArrayType(T.DoubleType(), False)),
    ])
    return rows.mapInArrow(project, schema).withColumn("deviation", F.col("deviation").cast("decimal(38,0)"))


def identity_error(white: DataFrame, components: int) -> float:
    """Largest absolute entry of the covariance of ``whitened`` (divisor n, centred first) minus the identity."""
    at = [F.get("whitened", F.lit(k)) for k in range(components)]
    means = white.agg(*[F.avg(c).alias(f"m{k}") for k, c in enumerate(at)]).first()
    centred = [c - F.lit(means[k]) for k, c in enumerate(at)]
    pairs = [(a, b) for a in range(components) for b in range(a, components)]
    found = white.agg(*[F.avg(centred[a] * centred[b]) for a, b in pairs]).first()
    return max(abs(v - (a == b)) for v, (a, b) in zip(found, pairs))


def whitened_components(df: DataFrame, keep: Sequence[str], vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: ``_row``, component, n, deviation, whitened, explained, identity_error."""
    rows = stage(whole_vectors(df, keep, vector), "whole-vectors")
    model = fit(rows, components)
    if model is None or not model.values:
        schema = T.StructType([T.StructField("_row", rows.schema["_row"].dataType)])
        return df.sparkSession.createDataFrame([], schema).select(
            "_row", *[F.lit(None).cast(kind).alias(name) for name, kind in RESULT.items()]
        )
    white = stage(whiten(rows, model), "whitened")
    error = identity_error(white, len(model.values))
    shares: Column = F.array(*[F.lit(v / model.trace) for v in model.values])
    spread = white.select("_row", "deviation", F.posexplode("whitened").alias("_k", "whitened"))
    return spread.select(
        "_row", (F.col("_k") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("_k")).alias("explained"), F.lit(error).alias("identity_error"),
    )


RESULT = {
    "component": "int", "n": "long", "deviation": "decimal(38,0)", "whitened": "double", "explained": "double",
    "identity_error": "double",
}
