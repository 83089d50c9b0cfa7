"""Benchmark the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_RUNS (timed runs per query, default 3; the best is kept).
Each query runs to completion on a ``noop`` sink: the whole plan executes
(scan, shuffles, aggregation, final projection) without shipping rows to the
driver.  One untimed warm-up pass precedes the timed runs.  The same
queries are also timed including ``collect()`` (``queries_with_collect``),
writing the JSON lake and reading it back.  ``stream_pings_per_sec`` is the
live application (every output, 8 streaming queries) replayed over the same
pings; the reference states an input rate of 10 pings/s.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from geopulse.plans import batch as B  # noqa: E402
from geopulse.session import build_session  # noqa: E402

HEADLINE = {
    "enriched": B.q_enriched,
    "zone_occupancy": B.q_zone_occupancy,
    "trip_sessions": B.q_trip_sessions,
    "perf_metrics": B.q_perf_metrics,
    "perf_metrics_sliding": B.q_perf_metrics_sliding,
    "live_state": B.q_live_state,
    "trip_segments": B.q_trip_segments,
    "haversine": B.q_haversine,
    "lake_partitions": B.q_lake_partitions,
}


def run_once(spark, fn, sf_dir) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def run_collect(spark, fn, sf_dir) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).collect()
    return time.perf_counter() - t0


#: The outputs that all rounds' figures include, beside the lake and cache branches.
STREAM_OUTPUTS = ["zone_occupancy", "anomalies", "trip_sessions", "perf_metrics", "perf_metrics_sliding", "live_state"]


def stream_throughput(spark, sf_dir) -> dict:
    """Pings per second through the live application: JSON messages decoded into the log
    and six outputs and the branches from it, replayed as 4 time chunks with availableNow."""
    from geopulse.plans.live_app import start_live_app
    from geopulse.streaming.replay import run_replay

    pings = B.pings(spark, sf_dir)
    n = pings.count()
    queries = {}

    def writer(stream, run):
        started = start_live_app(stream.sparkSession, stream, run.output, trigger={"availableNow": True}, outputs=STREAM_OUTPUTS,
                                 late_rows=False)
        queries.update(started)
        return [q for k, q in started.items() if not k.startswith("_")]

    t0 = time.perf_counter()
    run_replay(spark, pings, None, "bench-live-app", chunks=4, writer=writer, raw=True)
    dt = time.perf_counter() - t0
    return {"stream_pings": n, "stream_seconds": round(dt, 3),
            "stream_pings_per_sec": round(n / dt, 1)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus, app_name="geopulse-bench")
    for fn in HEADLINE.values():
        run_once(spark, fn, sf_dir)
    times = {k: round(min(run_once(spark, fn, sf_dir) for _ in range(runs)), 3)
             for k, fn in HEADLINE.items()}
    collected = {k: round(min(run_collect(spark, fn, sf_dir) for _ in range(runs)), 3)
                 for k, fn in HEADLINE.items()}
    try:  # an extra figure: never let it cost the headline line
        stream = stream_throughput(spark, sf_dir)
    except Exception as e:  # noqa: BLE001
        stream = {"stream_error": f"{type(e).__name__}: {str(e)[:200]}"}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus,
                      "mode": "noop-sink, best of %d after warm-up" % runs,
                      "queries_with_collect": collected,
                      "total_with_collect": round(sum(collected.values()), 3),
                      **stream}))
    spark.stop()


if __name__ == "__main__":
    main()
