"""The skew-safe bucketed forms equal their brute-force definitions."""

import random
from datetime import datetime, timedelta

from surgecast.operators import decide as de
from surgecast.operators import islands as isl


def brute_islands(points, gap):
    out = []
    for key in sorted({k for k, _ in points}):
        ts = sorted(t for k, t in points if k == key)
        start = prev = ts[0]
        n = 1
        for t in ts[1:]:
            if (t - prev).total_seconds() > gap:
                out.append((key, start, prev, n))
                start, n = t, 0
            prev = t
            n += 1
        out.append((key, start, prev, n))
    return sorted(out)


def test_bucketed_islands_equal_brute_force(spark):
    random.seed(17)
    t0 = datetime(2024, 1, 1)
    pts = []
    for key in ["a", "b", "c"]:
        t = t0
        for _ in range(400):
            # gaps around the threshold, exact threshold hits included
            t += timedelta(seconds=random.choice([1, 60, 900, 1799, 1800, 1801, 3600, 7200, 30]))
            pts.append((key, t))
    df = spark.createDataFrame(pts, "k string, ts timestamp")
    got = sorted((r.k, r.start_time, r.end_time, r.n_points) for r in isl.islands(df, ["k"], "ts", gap_seconds=1800).collect())
    assert got == brute_islands(pts, 1800)


def test_overlap_join_equals_all_overlapping_pairs(spark):
    random.seed(23)
    t0 = datetime(2024, 1, 1)

    def span():
        s = t0 + timedelta(hours=random.randint(0, 24 * 20))
        return s, s + timedelta(hours=random.choice([0, 1, 5, 30, 80]))

    left = [(i, "x" if i % 2 else "y", *span()) for i in range(120)]
    right = [(str(j), "x" if j % 3 else "y", *span()) for j in range(150)]
    ldf = spark.createDataFrame(left, "interval int, sport string, start_ds timestamp, end_ds timestamp")
    rdf = spark.createDataFrame(right, "id string, sport string, start timestamp, end timestamp")
    got = sorted((r.interval, r.id) for r in de.overlap_join(ldf, rdf, keys=["sport"]).collect())
    want = sorted((i, j) for i, sl, ls, le in left for j, sr, rs, re_ in right if sl == sr and rs <= le and re_ >= ls)
    assert got == want
