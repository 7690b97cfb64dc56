"""STL, ESD and forest displacement against plain forms written from their definitions."""

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from surgecast.operators import anomaly as an
from surgecast.operators import forecast as fc
from surgecast.operators import forest as fo
from surgecast.operators import stl as st


def plain_loess(y, span, at, rw):
    """One local line: nearest ``span`` points, tricube weights, weighted least squares."""
    n = len(y)
    q = min(span, n)
    left = min(max(at - (q - 1) // 2, 0), n - q)
    x = np.arange(left, left + q)
    reach = max(at - x[0], x[-1] - at, 0) + ((span - n) // 2 if span > n else 0)
    w = np.zeros(q)
    for i, xi in enumerate(x):
        r = abs(xi - at) / reach
        w[i] = (1.0 if r <= 0.001 else 0.0 if r > 0.999 else (1 - r**3) ** 3) * rw[xi]
    w = w / w.sum()
    mean = (w * x).sum()
    var = (w * (x - mean) ** 2).sum()
    if math.sqrt(var) <= 0.001 * (n - 1):
        return (w * y[x]).sum()
    slope = (w * (x - mean) * y[x]).sum() / var
    return (w * y[x]).sum() + slope * (at - mean)


@pytest.mark.parametrize("n,span", [(40, 7), (40, 8), (40, 39), (12, 25), (5, 7), (30, 31)])
def test_loess_equals_one_line_at_a_time(n, span):
    rng = np.random.default_rng(n + span)
    y, rw = rng.normal(size=(n, 3)), rng.uniform(0.2, 1, (n, 3))
    got = st.loess(y, span, rw, beyond=1)
    for c in range(3):
        want = [plain_loess(y[:, c], span, at, rw[:, c]) for at in range(-1, n + 1)]
        assert np.allclose(got[:, c], want)


def plain_stl(y, period, robust=False, seasonal_span=7):
    """The published loops, a point at a time."""
    n = len(y)
    odd = lambda x: math.ceil(x) + (math.ceil(x) % 2 == 0)
    nt, nl = odd(1.5 * period / (1 - 1.5 / seasonal_span)), odd(period + 0.5)
    trend, rw = np.zeros(n), np.ones(n)
    for turn in range(16 if robust else 1):
        for _ in range(2 if robust else 5):
            cycle = np.zeros(n + 2 * period)
            for k in range(period):
                sub, w = (y - trend)[k::period], rw[k::period]
                for j in range(-1, len(sub) + 1):
                    cycle[k + (j + 1) * period] = plain_loess(sub, seasonal_span, j, w)
            low = np.convolve(np.convolve(np.convolve(cycle, np.ones(period) / period, "valid"), np.ones(period) / period, "valid"), np.ones(3) / 3, "valid")
            low = np.array([plain_loess(low, nl, i, np.ones(n)) for i in range(n)])
            seasonal = cycle[period : period + n] - low
            trend = np.array([plain_loess(y - seasonal, nt, i, rw) for i in range(n)])
        r = np.abs(y - trend - seasonal) / (6 * np.median(np.abs(y - trend - seasonal)))
        rw = np.where(r <= 0.001, 1.0, np.where(r > 0.999, 0.0, (1 - np.minimum(r, 1) ** 2) ** 2))
    return trend, seasonal


@pytest.mark.parametrize("robust", [False, True])
@pytest.mark.parametrize("n", [48, 53])
def test_stl_equals_the_plain_loops(n, robust):
    rng = np.random.default_rng(n)
    y = 5 + 0.1 * np.arange(n) + 3 * np.sin(2 * np.pi * np.arange(n) / 12) + rng.normal(0, 0.4, n)
    y[20] += 15
    trend, seasonal, resid = st.stl(y, 12, robust=robust)
    want_trend, want_seasonal = plain_stl(y, 12, robust)
    assert np.allclose(trend, want_trend, atol=1e-8) and np.allclose(seasonal, want_seasonal, atol=1e-8)
    assert np.allclose(trend + seasonal + resid, y)


def test_stl_needs_two_periods_and_repeats_if_periodic():
    with pytest.raises(ValueError, match="two periods"):
        st.stl(np.ones(23), 12)
    y = np.tile([1.0, 5.0, 2.0, 8.0], 12) + np.random.default_rng(1).normal(0, 0.1, 48)
    seasonal = st.stl(y, 4, robust=True, periodic=True)[1]
    assert np.allclose(seasonal[:4], seasonal[4:8]) and np.allclose(seasonal, np.tile(seasonal[:4], 12))
    assert np.abs(st.stl(np.full(60, 3.0), 12, robust=True)[2]).max() < 1e-9


def _frame(spark, vals):
    rows = [("s", datetime(2024, 1, 1) + timedelta(hours=i), float(v)) for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, "series_id string, ts timestamp, value double")


def test_outliers_under_a_shifting_season(spark):
    """The season's height doubles over the weeks; the classical form takes that for outliers or misses them."""
    rng = np.random.default_rng(5)
    n, day = 24 * 28, 24
    t = np.arange(n)
    y = 20 + (1 + t / n * 3) * 4 * np.sin(2 * np.pi * t / day) + rng.normal(0, 0.25, n)
    y[[200, 450]] += 3.0
    from surgecast.operators.decompose import with_index

    g = with_index(_frame(spark, y), ["series_id"], "ts")
    cleaned = {}
    for method in ("stl", "classical"):
        got = fc.residual_outliers(g, ["series_id"], "value", day, 4.0, out="cleaned", method=method).orderBy("ts").toPandas()
        cleaned[method] = set(np.flatnonzero(got.cleaned.isna()))
    assert {200, 450} <= cleaned["stl"] and len(cleaned["stl"]) < 8
    assert not {200, 450} <= cleaned["classical"]


def plain_esd(x, cap, alpha=0.01):
    """Remove the largest value again and again, sorting anew each time."""
    work, idx, removed, num = list(x), list(range(len(x))), [], 0
    for i in range(1, cap + 1):
        if len(work) < 3:
            break
        med = float(np.median(work))
        mad = 1.4826 * float(np.median(np.abs(np.array(work) - med)))
        if mad == 0:
            break
        j = int(np.argmax(work))
        r = (work[j] - med) / mad
        removed.append(idx[j])
        n = len(work)
        del work[j], idx[j]
        t = an.t_ppf(1 - alpha / n, n - 2)
        if r > t * (n - 1) / math.sqrt((n - 2 + t * t) * n):
            num = i
    return removed[:num]


def test_esd_equals_sorting_anew():
    rnd = random.Random(8)
    for _ in range(200):
        n = rnd.randint(3, 40)
        x = np.array([rnd.choice([rnd.gauss(0, 1), rnd.randint(0, 3), 30 * rnd.random()]) for _ in range(n)], float)
        assert an.esd_positive(x, n) == plain_esd(x, n)


def test_t_quantile_equals_published_values():
    for p, df, want in [(0.95, 1, 6.313751514675), (0.975, 2, 4.302652729749), (0.999, 30, 3.385184866891), (0.995, 120, 2.617421145106), (0.05, 5, -2.015048372669), (0.5, 9, 0.0)]:
        assert an.t_ppf(p, df) == pytest.approx(want, abs=1e-9)


def test_caps_by_sport(spark):
    rng = np.random.default_rng(3)
    rows = []
    for sport in ("hockey", "football", "chess"):
        y = 10 + 3 * np.sin(2 * np.pi * np.arange(24 * 90) / 24) + rng.normal(0, 0.2, 24 * 90)
        y[[500, 501, 900]] += 25
        rows += [(sport, datetime(2024, 1, 1) + timedelta(hours=i), float(v)) for i, v in enumerate(y)]
    df = spark.createDataFrame(rows, "sport string, ts timestamp, value double")
    out = an.group_anomalies(df, "ts", period=24, caps=an.SPORT_CAPS, gap_seconds=3600).collect()
    by = {s: sorted((r.start_time, r.n_points) for r in out if r.sport == s) for s in ("hockey", "football", "chess")}
    assert sum(n for _, n in by["hockey"]) == 1  # floor(2160 * 0.0005)
    assert sum(n for _, n in by["football"]) == 2 and by["chess"] == []
    assert {r.annotation for r in out} == {"based on the history of hockey predictions", "based on the history of football predictions"}


def plain_displacement(nodes, boxes, p):
    """Expected largest ratio by walking down one point, all places weighed."""
    total, stays, at, ratios = 0.0, 1.0, 0, [0.0]
    while True:
        lo, hi = boxes[at]
        wider = sum(max(a - x, 0) + max(x - b, 0) for a, b, x in zip(lo, hi, p))
        whole = wider + sum(b - a for a, b in zip(lo, hi))
        part = wider / whole if whole else 0.0
        total += stays * part * max(nodes[at][4], max(ratios))
        stays *= 1 - part
        if nodes[at][0] < 0:
            return total + stays * max(ratios)
        child = nodes[at][2] if p[nodes[at][0]] <= nodes[at][1] else nodes[at][3]
        ratios.append((nodes[at][4] - nodes[child][4]) / (nodes[child][4] + 1))
        at = child


@pytest.mark.parametrize("seed", range(6))
def test_displacement_equals_walking_each_point(seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 6, (30, 3)).astype(float) if seed % 2 else rng.normal(size=(30, 3))
    nodes = fo.build_tree(x, rng)
    leaves = [n for n in nodes if n[0] < 0]
    assert sum(n[4] for n in leaves) == 30 and all(n[4] == (x == n[5]).all(1).sum() for n in leaves)
    place = np.array([n[5] if n[5] is not None else np.zeros(3) for n in nodes])
    tree = fo.Tree(*[np.array([n[i] for n in nodes]) for i in range(5)], place, place)

    def points(i):
        return [nodes[i][5]] if nodes[i][0] < 0 else points(nodes[i][2]) + points(nodes[i][3])

    boxes = [(np.min(points(i), axis=0), np.max(points(i), axis=0)) for i in range(len(nodes))]
    for i, (lo, hi) in enumerate(boxes):
        assert (tree.lo[i] == lo).all() and (tree.hi[i] == hi).all()
    probes = np.concatenate([x, rng.normal(0, 5, (40, 3))])
    assert np.allclose(tree.displacement(probes), [plain_displacement(nodes, boxes, p) for p in probes])


def test_expected_displacement_is_the_mean_of_random_insertions():
    """Insertions by drawn cuts, displacement counted in the tree that results."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(12, 2))
    nodes = fo.build_tree(x, rng)
    place = np.array([n[5] if n[5] is not None else np.zeros(2) for n in nodes])
    tree = fo.Tree(*[np.array([n[i] for n in nodes]) for i in range(5)], place, place)
    p = np.array([1.5, -2.0])

    def insert():
        at, path = 0, []
        while True:
            lo, hi = np.minimum(tree.lo[at], p), np.maximum(tree.hi[at], p)
            r = rng.uniform(0, (hi - lo).sum())
            dim = int(np.searchsorted(np.cumsum(hi - lo), r))
            cut = lo[dim] + r - (np.cumsum(hi - lo)[dim] - (hi - lo)[dim])
            if cut < tree.lo[at][dim] or cut > tree.hi[at][dim]:
                sizes = [(tree.size[at], 1)] + path
                return max(s / own for s, own in sizes)
            child = tree.left[at] if p[tree.dim[at]] <= tree.cut[at] else tree.right[at]
            path.append((tree.size[at] - tree.size[child], tree.size[child] + 1))
            at = child

    drawn = np.mean([insert() for _ in range(20_000)])
    assert tree.displacement(p[None])[0] == pytest.approx(drawn, rel=0.03)


def test_flags_follow_displacement(spark):
    rng = np.random.default_rng(2)
    rows = [(i, *map(float, v)) for i, v in enumerate(rng.normal(size=(400, 2)))] + [(400, 9.0, 9.0)]
    df = spark.createDataFrame(rows, "i int, a double, b double")
    trees = fo.rcf_fit(df, ["a", "b"], n_trees=20, sample_size=64)
    scored = an.quantile_flags(fo.rcf_score(df, trees, ["a", "b"]), "score", [0.95, 0.99])
    got = scored.where(F.col("`anomaly_0.99`")).orderBy(F.desc("score")).collect()
    assert got[0].i == 400 and len(got) <= 5
