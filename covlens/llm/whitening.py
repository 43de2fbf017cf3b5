"""Whitening of embeddings: principal components of a distributed covariance by mixed-precision refinement.

Entries become whole numbers on a grid (``floor(scale * c) + shift``), and the fit list has each
distinct vector once; Spark counts it with partial aggregation, so copies cost nothing after the
first. Two passes of partial sums over it give, per dimension, the exact total and then the
covariance of the centred vectors, centred before multiplying. What leaves the workers is a
row of d numbers and a triangle of d x d numbers for each partition, summed by Spark, so that the
driver gets d x d numbers whatever the rows.

The covariance's eigenvectors are computed in float32 and then corrected by the iterations of
Ogita and Aishima in higher precision (80-bit floats where the machine has them), which are matrix products only
and converge quadratically. Eigenvalues that lie too close for the correction to tell
apart are a cluster: the covariance projected on the cluster's vectors, less the cluster's mean, is
solved anew in double precision, which turns the vectors within their space, and the
iterations go on. Eigenvalues of which no more than rounding is left (``FLOOR`` of the
trace) give no component.

Rows whose vector is null or holds null, NaN or infinite entries are dropped, as are vectors of another length
than the most frequent one (the longest if several are). Entries are held within
``BOUND`` on the grid. A deviation beyond 64 bits is null. Repeated rows get equal rows; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from covlens.llm.common import Scratch, table

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Most grid units of an entry; products with the number of rows stay within exact integers.
BOUND = 1 << 46
#: Least share of the trace that an eigenvalue holds.
FLOOR = 1e-13
HIGH = np.longdouble


def grid(vector: Column, scale: int = SCALE, shift: int = SHIFT) -> Column:
    """Array of longs; null if the vector is null or holds an entry that is no finite number."""
    entry = lambda c: c.cast("double")
    sound = F.forall(vector, lambda c: F.coalesce(~F.isnan(entry(c)) & (F.abs(entry(c)) < float("inf")), F.lit(False)))
    held = lambda c: F.least(F.greatest(F.floor(F.least(F.greatest(entry(c), F.lit(-1e30)), F.lit(1e30)) * scale).cast("double"), F.lit(float(-BOUND))), F.lit(float(BOUND)))
    return F.when(sound & (F.size(vector) > 0), F.transform(vector, lambda c: held(c).cast("long") + shift))


def matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, d)


def totals(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Rows and exact per-dimension sums of ``x``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for b in batches:
            x = matrix(b.column(0), d)
            n += len(x)
            high += (x >> 24).sum(0)
            low += (x & 0xFFFFFF).sum(0)
        yield pa.RecordBatch.from_pydict({"dim": pa.array([-1, *range(d)], pa.int32()), "high": pa.array([n, *high.tolist()], pa.int64()), "low": pa.array([0, *low.tolist()], pa.int64())})

    rows = fit.select("x").mapInArrow(run, "dim int, high long, low long").groupBy("dim").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    by = {r.dim: (r.high, r.low) for r in rows}
    return by.get(-1, (0, 0))[0], [(by[k][0] << 24) + by[k][1] for k in range(d)] if by else []


def second_moments(fit: DataFrame, d: int, centre: np.ndarray, basis: np.ndarray | None = None) -> np.ndarray:
    """Sum of the outer products of the centred vectors, projected on ``basis`` if given, by partial sums of rows of the matrix."""
    width = d if basis is None else basis.shape[1]
    held = fit.sparkSession.sparkContext.broadcast((centre, basis))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, onto = held.value
        total = np.zeros((width, width))
        for b in batches:
            x = matrix(b.column(0), d)
            for i in range(0, len(x), 4096):
                y = centred(x[i : i + 4096], mean)
                y = y if onto is None else y @ onto
                total += y.T @ y
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(width), pa.int32()), "row": pa.array(list(total), pa.list_(pa.float64()))})

    parts = fit.select("x").mapInArrow(run, "i int, row array<double>")
    cells = parts.select("i", F.posexplode("row").alias("j", "v")).where("j >= i").groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((width, width))
    for r in cells.collect():
        out[r.i, r.j] = out[r.j, r.i] = r.v
    return out


def centred(x: np.ndarray, mean: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """x less the mean, which is given as whole numbers and the rest, so that nothing cancels."""
    return (x - mean[0]) - mean[1]


def refine(v: np.ndarray, x: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors of the symmetric ``v`` from approximate vectors ``x`` (columns).

    Rounds of Ogita and Aishima's correction X + X E, with E from R = I - X'X and S = X'VX. What lies closer than
    the residuals can tell apart is a cluster and gets a solve of its own each round.
    """
    v, x = v.astype(HIGH), x.astype(HIGH)
    eps, size, last = float(np.finfo(HIGH).eps), float(np.linalg.norm(v.astype(float), 2)) or 1.0, np.inf
    for _ in range(rounds):
        r, s = np.eye(len(v), dtype=HIGH) - x.T @ x, x.T @ (v @ x)
        r, s = (r + r.T) / 2, (s + s.T) / 2  # else rounding, divided by small gaps, spoils orthogonality
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(values)
        norm = lambda m: float(np.linalg.norm(m.astype(float), 2))
        delta = 2 * (norm(off) + size * norm(r))
        gap = values[None, :] - values[:, None]
        near = np.abs(gap.astype(float)) <= delta
        with np.errstate(divide="ignore", invalid="ignore"):
            e = np.where(near, r / 2, (s + values[None, :] * r) / gap)
        np.fill_diagonal(e, np.diag(r) / 2)
        x = x + x @ e
        order = np.argsort(-values.astype(float), kind="stable")
        x, values = x[:, order], values[order]
        split = np.flatnonzero(-np.diff(values.astype(float)) > delta) + 1
        for cluster in np.split(np.arange(len(v)), split):
            if len(cluster) > 1:
                x[:, cluster] = turned(v, x[:, cluster])
        residual = norm(off) + size * norm(r)
        if residual <= 64 * eps * size or residual >= last / 2 and residual <= 1e6 * eps * size:
            break
        last = residual
    values = np.array([float(x[:, k] @ (v @ x[:, k]) / (x[:, k] @ x[:, k])) for k in range(len(v))])
    order = np.argsort(-values, kind="stable")
    x = (x / np.sqrt((x * x).sum(0)))[:, order]
    return values[order], x.astype(float)


def turned(v: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The vectors of a cluster, made orthonormal and turned within their space to the eigenvectors of ``v`` less the cluster's mean."""
    for _ in range(2):
        x = x + x @ (np.eye(x.shape[1], dtype=HIGH) - x.T @ x) / 2
    mean = np.trace(x.T @ (v @ x)) / x.shape[1]
    inner = x.T @ (v @ x - mean * x)
    scale = np.abs(inner).max()
    if not scale:
        return x
    _, q = np.linalg.eigh(((inner + inner.T) / (2 * scale)).astype(float))
    return x @ q[:, ::-1].astype(HIGH)


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and eigenvectors of the symmetric ``v`` to double precision, from a float32 solution."""
    scale = float(np.abs(v).max()) or 1.0
    _, x = np.linalg.eigh((v / scale).astype(np.float32))
    values, x = refine(v / scale, x)
    return values * scale, x


def whiten(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """Per row with a sound vector and component: id, component, n, deviation, whitened, explained, identity_error.

    ``n`` is the length of the fit list, ``deviation`` the exact sum over dimensions of (n*x - S)^2,
    ``explained`` the component's share of the trace. ``identity_error`` is measured: the largest
    entry of the whitened fit list's covariance less the identity. Other columns of the input are not read.
    """
    spark, scratch = rows.sparkSession, Scratch(rows.sparkSession)
    result = f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    sound = rows.select(F.col(f"`{id_col}`").alias("id"), grid(F.col(f"`{vector}`"), scale, shift).alias("x")).where("x is not null")
    distinct = scratch.cut(sound.select("x").distinct())
    lengths = distinct.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return spark.createDataFrame([], result)
    d = lengths.d
    fit = distinct.where(F.size("x") == d)
    n, sums = totals(fit, d)
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    v = second_moments(fit, d, (whole, rest)) / n
    values, vectors = eigen(v)
    trace = float(np.trace(v))
    k = int((values[:components] > FLOOR * trace).sum())
    basis = vectors[:, :k] / np.sqrt(values[:k])
    error = float(np.abs(second_moments(fit, d, (whole, rest), basis) / n - np.eye(k)).max()) if k else 0.0
    scratch.clear()
    explained = values[:k] / trace if trace else values[:k]
    held = spark.sparkContext.broadcast((whole, rest, basis, explained, sums))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, rest, basis, explained, sums = held.value
        left = [s - n * int(w) for s, w in zip(sums, whole, strict=True)]  # n*x - S is n*(x - whole) - left
        for b in batches:
            for i in range(0, b.num_rows, 2048):
                part = b.slice(i, 2048)
                x = matrix(part.column(1), d)
                y = centred(x, (whole, rest)) @ basis
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(np.repeat(np.arange(len(x)), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(x) * k, n, np.int64)),
                    pa.array(np.repeat(np.array(deviations(x - whole, n, left), object), k), pa.int64()), pa.array(y.ravel()),
                    pa.array(np.tile(explained, len(x))), pa.array(np.full(len(x) * k, error))],
                    names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return sound.where(F.size("x") == d).mapInArrow(run, result)


def deviations(z: np.ndarray, n: int, left: list[int]) -> list[int | None]:
    """The exact sum over dimensions of (n*z - left)^2 for each row; null beyond 64 bits."""
    most = n * (int(np.abs(z).max(initial=0)) + 1)
    if most * most * z.shape[1] < 1 << 63:
        y = n * z - np.array(left, np.int64)
        return (y * y).sum(1).tolist()
    exact = [sum((n * int(c) - s) ** 2 for c, s in zip(row, left, strict=True)) for row in z]
    return [e if e < 1 << 63 else None for e in exact]


def op12_refined_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
