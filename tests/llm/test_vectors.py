"""Whitening: the eigenvectors and the operator against plain numpy."""

import math

import numpy as np
import pytest

from marketlake.llm.common import table
from marketlake.llm.whitening import eigenvectors, whiten


def _turned(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values),) * 2))[0].astype(np.longdouble)
    for _ in range(3):
        q = q + q @ (np.eye(len(values)) - q.T @ q) / 2
    return ((q * np.array(values, np.longdouble)) @ q.T).astype(np.float64)


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(1, 90, 40),
        [5, 3, 1e-7, 0, 0],
        [2, 2, 2, 1],
        [1 + 1e-9, 1, 1 - 1e-9, 0.5, 0.5 + 1e-12, 1e-3],
        np.repeat([80.0, 79.9999999], 20) + np.arange(40) * 1e-11,
        [7],
        np.exp(-np.arange(60.0)),
    ],
)
def test_eigenvectors(values):
    a = _turned(values)
    a = (a + a.T) / 2
    found, x = eigenvectors(a)
    want = np.linalg.eigvalsh(a)[::-1]
    size = np.abs(want).max()
    assert np.allclose(found, want, rtol=0, atol=1e-14 * size * len(want))
    wide = x.astype(np.longdouble)
    assert np.abs(wide.T @ wide - np.eye(len(a))).max() < 1e-15
    # the residual is that of vectors rounded to doubles
    assert np.abs(a.astype(np.longdouble) @ wide - wide * (wide * (a @ wide)).sum(0)).max() < 1e-15 * size


def test_no_variance():
    values, x = eigenvectors(np.zeros((3, 3)))
    assert not values.any() and (x == np.eye(3)).all()


def _plain(vectors, k=16):
    """vec_id -> list of (n, deviation, |whitened|, explained) by exact integers and numpy's eigenvectors."""
    rows = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in vectors if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in rows})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums, strict=True)] for x in fit])
    cov = centred.T @ centred / n
    e, vec = np.linalg.eigh(cov)
    e, vec = e[::-1][:k], vec[:, ::-1][:, :k]
    out = []
    for i, x in rows:
        d = [n * c - s for c, s in zip(x, sums, strict=True)]
        w = np.array(d) / n @ vec / np.sqrt(e)
        out.append((i, n, sum(v * v for v in d), np.abs(w), e / np.trace(cov)))
    return out


def test_equals_plain(spark):
    rng = np.random.default_rng(3)
    data = [(k, rng.normal(size=20).astype(np.float32).tolist()) for k in range(400)]
    data += [(k, data[0][1]) for k in range(500, 620)] + [(None, data[1][1]), (3, data[3][1])]
    bad = [(900, None), (901, []), (902, [None] * 20), (903, [float("nan")] + [0.0] * 19), (904, [0.0] * 19 + [float("inf")]), (905, [0.5] * 7)]
    df = spark.createDataFrame([(i, v, 1, 2, "x") for i, v in data + bad], "vec_id long, embedding array<float>, n long, at int, i string")
    got = whiten(df).collect()
    want = _plain(data)
    assert len(got) == 16 * len(want)
    key = lambda r: (repr(r[0]), r[2])
    by_row = sorted({(r.vec_id, r.n, r.deviation) for r in got}, key=key)
    assert by_row == sorted({w[:3] for w in want}, key=key)
    plain = {w[0]: w for w in want}
    for r in got:
        w = plain[r.vec_id]
        assert abs(abs(r.whitened) - w[3][r.component - 1]) < 1e-9 and abs(r.explained - w[4][r.component - 1]) < 1e-12
        assert r.identity_error < 1e-9


def test_table(spark, tables):
    vectors = table(spark, tables, "embeddings")
    got = whiten(vectors).toPandas()
    w = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert got.identity_error.max() < 1e-9 and w.shape == (vectors.count(), 16)
    assert np.abs(np.cov(w.T, bias=True) - np.eye(16)).max() < 1e-3


def test_few_rows_and_few_dimensions(spark):
    kind = "vec_id long, embedding array<double>"
    assert whiten(spark.createDataFrame([], kind)).columns == whiten(spark.createDataFrame([(1, [1.0])], kind)).columns
    assert whiten(spark.createDataFrame([(1, None)], kind)).count() == 0
    one = whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], kind)).collect()
    assert len(one) == 4 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one} == {(1, 0, 0.0, 0.0, 0.0)}
    far = whiten(spark.createDataFrame([(1, [1e30, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 2.0])], kind)).collect()
    assert {r.deviation for r in far} == {None} and {r.n for r in far} == {3}
