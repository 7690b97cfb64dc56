"""Distributed boosting against a single-process form on the same bins."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from surgecast.operators import boosting as bo


def plain_fit(x, y, w, s, edges):
    """Exact greedy trees over bins, all rows in one array, by their definition."""
    bins = np.stack([np.where(np.isnan(x[:, j]), 0, 1 + np.searchsorted(e, x[:, j], "left")) for j, e in enumerate(edges)], 1)
    f = np.full(len(y), s.base)
    shrink = lambda g: np.sign(g) * max(abs(g) - s.l1, 0)

    def grow(idx, depth):
        g, h = (w * (f - y))[idx].sum(), w[idx].sum()
        best = None
        if depth < s.depth:
            for j in range(x.shape[1]):
                for b in range(int(bins[:, j].max())):
                    low = idx[bins[idx, j] <= b]
                    lg, lh = (w * (f - y))[low].sum(), w[low].sum()
                    if lh < s.min_weight or h - lh < s.min_weight:
                        continue
                    gain = (shrink(lg) ** 2 / (lh + s.l2) + shrink(g - lg) ** 2 / (h - lh + s.l2) - shrink(g) ** 2 / (h + s.l2)) / 2 - s.gamma
                    if gain > 1e-12 and (best is None or gain > best[0] + 1e-9):
                        best = gain, j, b
        if best is None:
            out[idx] = -s.eta * shrink(g) / (h + s.l2)
            return
        _, j, b = best
        grow(idx[bins[idx, j] <= b], depth + 1)
        grow(idx[bins[idx, j] > b], depth + 1)

    for _ in range(s.rounds):
        out = np.zeros(len(y))
        grow(np.arange(len(y)), 0)
        f = f + out
    return f


@pytest.mark.parametrize("l1,l2,gamma,min_weight", [(0.0, 1.0, 0.0, 1.0), (2.0, 0.5, 0.3, 3.0)])
def test_equals_the_single_process_form(spark, monkeypatch, l1, l2, gamma, min_weight):
    monkeypatch.setattr(bo, "REWRITE", 2)
    rng = np.random.default_rng(4)
    n = 300
    x = np.round(rng.normal(size=(n, 3)), 1)
    x[rng.random((n, 3)) < 0.1] = np.nan
    y = np.nan_to_num(x[:, 0]) * 2 + (np.nan_to_num(x[:, 1]) > 0.3) * 3 + rng.normal(0, 0.1, n)
    w = rng.uniform(0, 2, n)
    rows = [(i, *[None if np.isnan(v) else float(v) for v in x[i]], float(y[i]), float(w[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id int, a double, b double, `c.d` double, y double, w double").repartition(5)
    s = bo.BoostSettings(rounds=5, depth=3, eta=0.3, l1=l1, l2=l2, gamma=gamma, min_weight=min_weight, bins=16)
    model = bo.fit(df, ["a", "b", "c.d"], s, weight="w")
    want = plain_fit(x, y, w, s, model.edges)
    assert np.allclose(model.predict(x), want, atol=1e-9)
    assert np.mean((want - y) ** 2) < 0.7 * np.var(y)
    got = {r.id: r.prediction for r in bo.score(df.withColumn("prediction", F.lit("old")), model).collect()}
    assert np.allclose([got[i] for i in range(n)], want, atol=1e-9)
    again = bo.from_table(bo.to_table(spark, model))
    assert np.array_equal(again.predict(x), model.predict(x)) and again.features == model.features


def test_edges_of_boosting(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 3.0), (None, None), (None, 3.0)], "a double, y double")
    with pytest.raises(ValueError, match="no rows"):
        bo.fit(df.where("y > 9"), ["a"])
    flat = bo.fit(df, ["a"], bo.BoostSettings(rounds=60, eta=1.0, l2=0.0))
    assert np.allclose(flat.predict(np.array([[1.0], [np.nan], [7.0]])), 3.0) and len(flat.trees) < 60
    unweighted = bo.fit(df.withColumn("w", F.lit(-1.0)), ["a"], bo.BoostSettings(rounds=2), weight="w")
    assert np.allclose(unweighted.predict(np.array([[1.0]])), 0.5)
