"""Whitening against numpy, with exact sums."""

from fractions import Fraction

import numpy as np
import pytest

from shiftline.llm import whitening
from shiftline.llm.whitening import whiten

VECTORS = "vec_id long, embedding array<float>, n long, block long, x string"


def some_vectors(rng, width=12, n=130):
    axes = rng.standard_normal((width, width)) * np.linspace(0.05, 1.5, width)
    rows = [[float(x) for x in np.float32(rng.standard_normal(width) @ axes)] for _ in range(n)]
    rows += [rows[3]] * 60  # copies count once in the fit
    return rows


@pytest.mark.parametrize("values", [48])
def test_whitening(spark, monkeypatch, values):
    """Small blocks make grids with several rows and splits."""
    monkeypatch.setattr(whitening, "BLOCK_VALUES", values)
    monkeypatch.setattr(whitening, "SPLIT_BLOCKS", 2)
    rows = list(enumerate(some_vectors(np.random.default_rng(5))))
    wide = [(1000 + i, [float(i % 3), 2.0]) for i in range(9)]  # another dimension, one constant entry
    odd = [None, [], [float("nan")] * 12, [1.0, None] * 6, [float("inf")] * 12, [1.0] * 5]
    rows += wide + [(2000 + i, v) for i, v in enumerate(odd)] + [(None, rows[7][1]), rows[8]]
    df = spark.createDataFrame([(i, v, 1, 1, "") for i, v in rows], VECTORS).repartition(4)
    found = whiten(df, components=7).toPandas()

    x = np.array([v for i, v in rows if v and len(v) == 12 and None not in v and np.isfinite(v).all()])
    whole = np.floor(64 * x).astype(int) + 1_000_000
    fit = np.unique(whole, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    ours = found[~found.vec_id.between(1000, 1999)]
    assert len(ours) == 7 * len(whole)
    assert (ours.n == n).all() and found.identity_error.max() < 1e-9
    known = {i: v for i, v in rows if v and len(v) == 12}
    signs = {}
    for row in ours.itertuples():
        own = np.floor(64 * np.array(known[7 if np.isnan(row.vec_id) else int(row.vec_id)])).astype(int)
        off = n * (own + 1_000_000) - sums
        assert int(row.deviation) == sum(int(d) ** 2 for d in off)
        k = row.component - 1
        plain = (off / n) @ vectors[:, k] / np.sqrt(values[k])
        sign = signs.setdefault(k, np.sign(plain * row.whitened))
        assert row.whitened == pytest.approx(sign * plain, abs=1e-9)
        assert row.explained == pytest.approx(values[k] / values.sum(), rel=1e-9)
    small = found[found.vec_id.between(1000, 1999)]
    assert len(small) == 9 and set(small.component) == {1}  # the constant entry has no direction
    assert sorted({round(abs(w), 9) for w in small.whitened}) == [0, round(float(np.sqrt(1.5)), 9)]
    assert set(small.deviation) == {0, int(Fraction(3 * 64) ** 2)}


def test_nothing_to_whiten(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], 1, 1, ""), (2, [1.0, 2.0], 1, 1, ""), (3, None, 1, 1, "")], VECTORS)
    assert whiten(df).count() == 0  # a single distinct vector
    assert whiten(df.limit(0)).columns == whiten(df).columns
    huge = spark.createDataFrame([(1, [3e38, 1.0], 1, 1, ""), (2, [-3e38, 1.0], 1, 1, "")], VECTORS)
    assert whiten(huge).count() == 2
