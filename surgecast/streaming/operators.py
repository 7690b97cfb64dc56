"""Streaming operators (ST1-ST4).

Each takes a streaming DataFrame and returns a streaming DataFrame; state is
bounded by watermarks, in ST3 also by a fixed-size window per key that
expires. ``run_to_table`` runs a query with the ``availableNow`` trigger into a
Parquet sink with its checkpoint under the session's shared checkpoint folder
(restartable after executor or driver loss) and returns the written table.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from surgecast.operators.anomaly import SmoothedScore
from surgecast.sinks.files import scratch_path


def windowed_counts(stream: DataFrame, keys: Sequence[str], ts: str = "ts", value: str = "value", *,
                    window: str = "5 minutes", watermark: str = "10 minutes", exact: str | None = None) -> DataFrame:
    """ST1: tumbling-window traffic per key with late data bounded by the watermark.

    Values are added as they are; ``exact`` names a decimal type to add them in
    where the order of addition must not matter. Windows the watermark hasn't
    passed at the end of a bounded run are not emitted."""
    amount = F.col(value).cast(exact) if exact else F.col(value).cast("double")
    s = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    return s.groupBy(F.window(ts, window).alias("w"), *keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(amount).cast("double").alias("total")
    ).select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", "total")


def online_periods(stream: DataFrame, keys: Sequence[str], ts: str = "ts", *, gap: str = "30 minutes",
                   watermark: str = "1 hour") -> DataFrame:
    """ST2: anomalous periods as session windows, emitted once the watermark passes them
    (so not those still open at the end of a bounded run)."""
    s = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    return s.groupBy(*keys, F.session_window(ts, gap).alias("s")).agg(
        F.min(ts).alias("start_time"), F.max(ts).alias("end_time"), F.count(F.lit(1)).alias("n_points")
    ).drop("s")


def dedupe_points(stream: DataFrame, keys: Sequence[str], ts: str = "ts", *, watermark: str = "1 hour") -> DataFrame:
    """ST4: one row per (keys, ts) within the watermark (late duplicates dropped)."""
    s = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    return s.withWatermark(ts, watermark).dropDuplicatesWithinWatermark([*keys, ts])


def zscore_stream(stream: DataFrame, key: str, ts: str, value: str, *, lag: int, threshold: float, influence: float,
                  watermark: str = "1 hour", idle: str = "7 days") -> DataFrame:
    """ST3: smoothed z-score online, in time order whatever the order of arrival.

    Points wait in the key's state until the watermark has passed them and are
    then scored by time, so points that arrive in order or shuffled within the
    watermark give the batch result. Later ones are dropped. State per key: the
    last ``lag`` filtered values and the points of one watermark's length; a key
    without points for ``idle`` (event time) loses its state and starts anew.
    Points the watermark hasn't passed at the end of a bounded run wait for the next.
    """
    out_schema = T.StructType([
        T.StructField(key, stream.schema[key].dataType), T.StructField(ts, stream.schema[ts].dataType),
        T.StructField(value, T.DoubleType()), T.StructField("signal", T.IntegerType()),
        T.StructField("avg_filter", T.DoubleType()), T.StructField("std_filter", T.DoubleType()),
    ])
    numbers, times = T.ArrayType(T.DoubleType()), T.ArrayType(T.LongType())
    state_schema = T.StructType([T.StructField("window", numbers), T.StructField("times", times), T.StructField("values", numbers), T.StructField("newest", T.LongType())])
    idle_ms = int(pd.Timedelta(idle).total_seconds() * 1000)
    names = [f.name for f in out_schema.fields]

    def step(k, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        passed = state.getCurrentWatermarkMs()
        window, at, held, newest = state.get if state.exists else ((), (), (), 0)
        waiting = list(zip(at, held))
        for pdf in batches:
            micros = pdf[ts].astype("datetime64[us]").astype("int64")
            waiting += [p for p in zip(micros.tolist(), pdf[value].astype(float).tolist()) if p[0] > passed * 1000]
        waiting.sort(key=lambda p: p[0])
        newest = max([newest, *(p[0] for p in waiting)])
        due = bisect.bisect_right(waiting, passed * 1000, key=lambda p: p[0])
        score = SmoothedScore(lag, threshold, influence, list(window))
        rows = [(k[0], pd.Timestamp(t, unit="us"), y, *score.push(y)) for t, y in waiting[:due]]
        waiting = waiting[due:]
        if not waiting and passed >= newest // 1000 + idle_ms:
            state.remove()
        else:
            state.update((score.window(), [t for t, _ in waiting], [y for _, y in waiting], newest))
            wake = waiting[0][0] // 1000 + 1 if waiting else newest // 1000 + idle_ms
            state.setTimeoutTimestamp(max(wake, passed + 1))
        if rows:
            yield pd.DataFrame(rows, columns=names)

    s = stream.withWatermark(ts, watermark)
    return s.groupBy(key).applyInPandasWithState(step, out_schema, state_schema, "append", GroupStateTimeout.EventTimeTimeout)


def run_to_table(spark: SparkSession, stream: DataFrame, name: str, *, mode: str = "append") -> DataFrame:
    """Run ``stream`` over everything available now into Parquet; return the result table."""
    out, ckpt = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
    q = (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
         .outputMode(mode).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)
