"""Benchmark: headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``.

Each query is run once to warm up, then ``$BENCH_REPEAT`` times (default 3);
the best time counts. Results are written to Spark's no-op sink, so every
row is computed and nothing is collected. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from surgecast.plans import catalog  # noqa: E402
from surgecast.session import get_session  # noqa: E402

HEADLINE = [
    "attribution_extra_traffic",      # slice 0: AGG1, JON1, JON2/3, PRJ5-7, WIN1
    "coevent_aggregate_form",         # JON1 as per-time aggregate + join (default)
    "coevent_window_form",            # JON1 as window sum partitioned by time
    "event_target_max",               # GEN1, JON4, AGG3, JON5
    "anomaly_islands",                # WIN4
    "regression_metrics_by_model",    # AGG8
    "metric_alignment_lags",          # JON10, WIN3, AGG9
    "encoded_features",               # ML1-ML4
    "nrt_forecast_composed",          # TS9 (with TS1-TS8)
    "smoothed_zscore_signals",        # TS10
    "traffic_intervals",              # DEC3
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus))
    reg = catalog.registry()
    names = [q for q in (only or HEADLINE) if q in reg]
    times: dict[str, float] = {}
    for name in names:
        fn = reg[name].fn
        best = None
        for i in range(repeat + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i > 0:
                best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_best_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
