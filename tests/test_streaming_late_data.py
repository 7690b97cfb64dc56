"""ST1 drops events later than the watermark across restarts from one checkpoint."""

from datetime import datetime

from surgecast.sinks.files import scratch_path
from surgecast.streaming import operators as st

SCHEMA = "k string, ts timestamp, value double"


def _run(spark, src, out, ckpt):
    s = spark.readStream.schema(SCHEMA).parquet(src)
    q = (st.windowed_counts(s, ["k"], "ts", "value", window="1 hour", watermark="1 hour")
         .writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()


def test_late_event_is_dropped_after_restart(spark):
    src, out, ckpt = (scratch_path(spark, n) for n in ("late-src", "late-out", "late-ckpt"))
    first = [("a", datetime(2024, 1, 1, h, 10), 1.0) for h in range(0, 6)]
    spark.createDataFrame(first, SCHEMA).coalesce(1).write.mode("append").parquet(src)
    _run(spark, src, out, ckpt)
    # watermark is now 05:10 - 1h = 04:10: the 01:00 window is closed; 07:00-09:00 advance the watermark
    second = [("a", datetime(2024, 1, 1, 1, 30), 100.0)] + [("a", datetime(2024, 1, 1, h, 5), 1.0) for h in (7, 8, 9)]
    spark.createDataFrame(second, SCHEMA).coalesce(1).write.mode("append").parquet(src)
    _run(spark, src, out, ckpt)
    rows = {r.window_start.hour: (r.n, r.total) for r in spark.read.parquet(out).collect()}
    assert rows[1] == (1, 1.0)  # the late 01:30 event did not change the finished window
    assert all(rows[h] == (1, 1.0) for h in (0, 2, 3, 4, 5, 6) if h in rows)
    assert 5 in rows and 7 in rows  # windows closed by the advanced watermark were emitted
