"""Whitening against a plain version and exact arithmetic; the refinement on close eigenvalues."""

import math
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from covlens.llm import whitening as wh
from covlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def plain(rows):
    """{id: [(n, deviation)]}, eigenvalues and |whitened| by exact sums and a double-precision solver."""
    sound = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in sound})
    n, total = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    mean = [Fraction(s, n) for s in total]
    y = np.array([[float(c - m) for c, m in zip(x, mean, strict=True)] for x in fit])
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = []
    for i, x in sound:
        w = np.array([float(c - m) for c, m in zip(x, mean, strict=True)]) @ vectors / np.sqrt(np.maximum(values, 1e-300))
        out.append((i, n, sum((n * c - s) ** 2 for c, s in zip(x, total, strict=True)), w))
    return out, values


def compare(got, rows, components):
    want, values = plain(rows)
    assert len(got) == len(want) * components
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {}).setdefault(r.component, r)
    signs = {}
    for i, n, deviation, w in want:
        for k in range(1, components + 1):
            r = by[i][k]
            assert (r.n, r.deviation) == (n, deviation)
            assert r.explained == pytest.approx(values[k - 1] / values.sum(), rel=1e-9)
            assert abs(r.whitened) == pytest.approx(abs(w[k - 1]), rel=1e-6, abs=1e-8) and r.identity_error < 1e-9
            if abs(w[k - 1]) > 1e-3:
                assert signs.setdefault(k, np.sign(r.whitened * w[k - 1])) == np.sign(r.whitened * w[k - 1])


def test_query_against_plain(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall()
    compare(QUERIES["op12_refined_whitening"](spark, SF).collect(), rows, 16)


def test_odd_rows(spark):
    r = np.random.default_rng(1)
    rows = [(i, r.normal(size=5).tolist()) for i in range(200)]
    rows += [(200, None), (201, [1.0, None, 1.0, 1.0, 1.0]), (202, [math.nan] * 5), (203, [math.inf, 0.0, 0.0, 0.0, 0.0]), (204, rows[3][1]), (204, rows[3][1]), (None, rows[4][1])]
    other = [(300, []), (301, [1.0, 2.0])]
    df = spark.createDataFrame([(*x, 7, "b") for x in rows + other], "vec_id long, embedding array<float>, N int, `a.whitened` string").repartition(4)
    f32 = [(i, v and [c if c is None else float(np.float32(c)) for c in v]) for i, v in rows]
    got = wh.whiten(df).collect()
    compare([x for x in got if x.vec_id != 204], [x for x in f32 if x[0] != 204], 5)
    assert sum(x.vec_id == 204 for x in got) == 10 and sum(x.vec_id is None for x in got) == 5
    assert wh.whiten(df.limit(0)).count() == 0 and wh.whiten(df.where("vec_id in (200, 201, 202, 203, 300)")).count() == 0


def test_vectors_without_spread(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert wh.whiten(df).count() == 0
    df = spark.createDataFrame([(i, [float(i), 2.0 * i, 1.0]) for i in range(9)], "vec_id long, embedding array<double>")
    rows = wh.whiten(df).collect()
    assert len(rows) == 9 and {x.component for x in rows} == {1} and rows[0].explained == pytest.approx(1)


def test_large_entries_are_held(spark):
    df = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0])], "vec_id long, embedding array<double>")
    rows = wh.whiten(df).collect()  # beside such entries the others are no more than rounding
    assert {x.vec_id: x.deviation is None for x in rows} == {1: True, 2: True, 3: False} and {x.component for x in rows} == {1}


def orthogonal(d, seed):
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))
    return q


@pytest.mark.parametrize("name, values", [
    ("apart", np.arange(1.0, 41)),
    ("two clusters", np.concatenate([1 + 1e-9 * np.arange(8), 5 + 1e-10 * np.arange(8), np.arange(10.0, 34)])),
    ("equal", np.concatenate([np.ones(20), 2 * np.ones(20)])),
    ("wide", 10.0 ** np.linspace(-10, 0, 40)),
    ("close to float32", 1 + 1e-7 * np.arange(40.0))])
def test_refinement(name, values):
    q = orthogonal(40, 3).astype(np.longdouble)
    for _ in range(4):
        q = q + q @ (np.eye(40) - q.T @ q) / 2
    v = ((q * values.astype(np.longdouble)) @ q.T).astype(float)
    v = (v + v.T) / 2
    got, x = wh.eigen(v)
    assert np.allclose(got, np.sort(values)[::-1], rtol=1e-14, atol=2e-15 * values.max())
    assert np.abs(x.T @ x - np.eye(40)).max() < 1e-14 and np.abs(v @ x - x * got).max() < 2e-14 * values.max()
    if name == "apart":  # better than the start by the precision in between
        assert np.abs(np.abs(x.T @ q[:, ::-1].astype(float)) - np.eye(40)).max() < 1e-13


def test_float32_alone_would_not_do():
    v = np.diag(np.arange(1.0, 65)) + 0.01
    x = np.linalg.eigh(v.astype(np.float32))[1]
    assert np.abs(x.T @ x - np.eye(64)).max() > 1e-8 > np.abs((y := wh.eigen(v)[1]).T @ y - np.eye(64)).max()


def test_sums_over_many_partitions_are_exact(spark):
    r = np.random.default_rng(5)
    x = r.integers(-(1 << 40), 1 << 40, (500, 3))
    df = spark.createDataFrame([(row.tolist(),) for row in x], "x array<long>").repartition(7)
    assert wh.totals(df, 3) == (500, [int(c) for c in x.astype(object).sum(0)])
