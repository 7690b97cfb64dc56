"""Randomised checks of the time rules against direct Python statements of them."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from surgecast.functions.timeparts import filler, quantize_next


def next_mark(t: datetime, step_min: int = 5) -> datetime:
    """Round up a minute when seconds >= 30, then take the strictly next mark."""
    if t.second >= 30:
        t = t + timedelta(minutes=1)
    marks = [m for m in range(0, 61, step_min) if m > t.minute]
    m = min(marks)
    base = t.replace(second=0, microsecond=0)
    return base.replace(minute=0) + timedelta(hours=1) if m == 60 else base.replace(minute=m)


def grid(start: datetime, end: datetime, step: int = 300):
    delta = int((end - start).total_seconds())
    return [start + timedelta(seconds=i) for i in range(-step, delta + 2 * step + 1, step)]


def test_quantize_random(spark):
    random.seed(7)
    ts = [datetime(2024, 1, 1) + timedelta(seconds=random.randint(0, 3 * 86400), microseconds=random.randint(0, 999999))
          for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in ts], "t timestamp")
    got = [r.q for r in df.select("t", quantize_next(F.col("t"), 300).alias("q")).orderBy("t").collect()]
    assert got == [next_mark(t) for t in sorted(ts)]


def test_filler_random(spark):
    random.seed(8)
    rows = []
    for _ in range(100):
        s = datetime(2024, 1, 1) + timedelta(minutes=5 * random.randint(0, 2000))
        rows.append((s, s + timedelta(minutes=5 * random.randint(0, 60))))
    df = spark.createDataFrame(rows, "s timestamp, e timestamp")
    got = {(r.s, r.e): r.f for r in df.select("s", "e", filler("s", "e", 300).alias("f")).collect()}
    for s, e in rows:
        assert got[(s, e)] == grid(s, e)
