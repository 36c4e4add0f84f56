"""Whitening by spectrum slicing against a full decomposition."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import slice_whiten
from strata.llm.queries import QUERIES


def symmetric(n, kind, seed=3):
    turn = np.random.default_rng(seed)
    a = turn.standard_normal((n, n))
    if kind == "spread":
        return a @ a.T
    if kind == "equal":
        return np.eye(n) * 3.0
    if kind == "zero":
        return np.zeros((n, n))
    q, _ = np.linalg.qr(a)
    values = np.ones(n)
    values[: min(n, 3)] = 5.0  # a triple eigenvalue on top
    if kind == "close":
        values[: min(n, 3)] = [5.0, 5.0 - 1e-9, 5.0 - 2e-9][: min(n, 3)]
    m = (q * values) @ q.T
    return (m + m.T) / 2


@pytest.mark.parametrize("n", [1, 2, 3, 9, 64])
@pytest.mark.parametrize("kind", ["spread", "equal", "zero", "triple", "close"])
def test_leading_eigenvalues(n, kind):
    m = symmetric(n, kind)
    values, vectors = slice_whiten.leading(m, 8)
    k, size = min(n, 8), max(1.0, np.abs(m).max())
    assert np.allclose(values, np.linalg.eigvalsh(m)[::-1][:k], atol=1e-12 * n * size)
    assert np.allclose(vectors @ vectors.T, np.eye(k), atol=1e-13)
    assert np.allclose(m @ vectors.T, vectors.T * values, atol=1e-12 * n * size)


def test_counts_are_those_of_the_matrix():
    m = symmetric(30, "spread")
    diagonal, off = slice_whiten.tridiagonal(m)
    values = np.linalg.eigvalsh(m)
    for shift in np.linspace(values[0] - 1, values[-1] + 1, 60):
        assert slice_whiten.count_below(diagonal, off, shift) == (values < shift).sum()


def plain(rows):
    """(id, component) -> whitened, with n, S, deviations and explained shares, of (id, vector) rows."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in kept], object)
    n, s = len(x), x.sum(axis=0)
    deviations = [int(((n * row - s) ** 2).sum()) for row in x]
    d = np.array((n * x - s) / n, float)
    v = d.T @ d / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    return kept, deviations, d @ vectors / np.sqrt(values), values / np.trace(v)


def test_given_embeddings(spark):
    data = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{data}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    kept, deviations, whitened, explained = plain(rows)
    out = QUERIES["op13_spectrum_slicing"](spark, data).collect()
    assert len(out) == 8 * len(kept)
    at = {i: k for k, (i, _) in enumerate(kept)}
    signs = {}
    for r in out:
        k, c = at[r.vec_id], r.component - 1
        assert r.n == len(kept) and r.deviation == deviations[k]
        assert r.explained == pytest.approx(explained[c], rel=1e-10)
        assert 0 <= r.identity_error < 1e-10
        sign = signs.setdefault(c, 1 if r.whitened * whitened[k, c] >= 0 else -1)
        assert sign * r.whitened == pytest.approx(whitened[k, c], abs=1e-8)


NAMES = ["component", "n", "deviation", "whitened", "explained", "identity_error", "cell", "dim"]


def frame(spark, rows, clashes=False):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    return df.withColumns({n: F.lit("clash") for n in NAMES}) if clashes else df


def test_odd_vectors(spark):
    turn = np.random.default_rng(5)
    good = [(i, [float(c) for c in turn.standard_normal(12) * 3]) for i in range(80)]
    good += [(None, good[0][1]), (5, good[5][1]), (7, good[3][1])]  # a null id, a repeated row and one with another vector
    bad = [(900, None), (901, [1.0] * 11 + [None]), (902, [float("nan")] * 12), (903, [float("inf")] + [0.0] * 11)]
    bad += [(904, []), (905, [1.0, 2.0]), (None, None)]
    out = slice_whiten.whiten(frame(spark, good + bad, clashes=True))
    assert out.columns == ["vec_id", *NAMES[:6]]
    rows = out.collect()
    kept, deviations, whitened, explained = plain(good)
    assert len(rows) == 8 * len(kept)
    expected = sorted((-1 if i is None else i, d) for (i, _), d in zip(kept, deviations) for _ in range(8))
    assert sorted((-1 if r.vec_id is None else r.vec_id, r.deviation) for r in rows) == expected
    for c in range(8):
        own = np.sort(np.abs([r.whitened for r in rows if r.component == c + 1]))
        assert np.allclose(own, np.sort(np.abs(whitened[:, c])), atol=1e-9)
    assert {r.identity_error for r in rows}.pop() < 1e-10


def test_tables_without_spread(spark):
    assert slice_whiten.whiten(frame(spark, [])).count() == 0
    assert slice_whiten.whiten(frame(spark, [(1, None), (2, [])])).count() == 0
    assert slice_whiten.whiten(frame(spark, [(i, [1.0, 2.0, 3.0]) for i in range(9)])).count() == 0
    # Three vectors spread over two dimensions at most.
    rows = slice_whiten.whiten(frame(spark, [(0, [0.0] * 10), (1, [1.0] * 10), (2, [1.0] * 5 + [0.0] * 5)])).collect()
    assert {r.component for r in rows} == {1, 2} and sum(r.explained for r in rows if r.vec_id == 0) == pytest.approx(1.0)


def test_a_deviation_beyond_64_bits_is_an_error():
    model = slice_whiten.Model(3, np.array([0, 0]), np.ones(0), np.zeros((0, 2)), 1.0)
    assert model.deviations(np.array([[10**8, 1]])) == [9 * 10**16 + 9]
    with pytest.raises(OverflowError):
        model.deviations(np.array([[10**10, 1]]))
