"""How the headline operators scale with input size on this machine.

The sf0.1 ``events`` table is replicated k times (event and user ids offset
per copy, so each copy adds new drivers) and written once as multi-file
canonical ping parquet under the scratch folder; the operators then read it
like real data.  Prints one JSON line per factor with seconds and pings/s.

Usage: python scripts/scale_probe.py [sf_dir] [factor ...]
"""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from geopulse.operators import enrich as E  # noqa: E402
from geopulse.operators import live as L  # noqa: E402
from geopulse.operators import trips as TR  # noqa: E402
from geopulse.operators import windows as W  # noqa: E402
from geopulse.session import build_session, scratch_dir  # noqa: E402
from geopulse.sources.events import events_to_pings, read_events  # noqa: E402

OPS = {
    "zone_occupancy": lambda p: W.zone_occupancy(E.enrich(p)),
    "perf_metrics_sliding": lambda p: W.perf_metrics_sliding(E.enrich(p)),
    "perf_metrics_sliding_panes": lambda p: W.perf_metrics_sliding(E.enrich(p), method="panes"),
    "perf_metrics": lambda p: W.perf_metrics(E.enrich(p)),
    "trip_sessions": lambda p: W.trip_sessions(E.enrich(p)),
    "derived_speed": lambda p: TR.derived_speed(p),
    "trip_segments": lambda p: TR.trip_segments(p),
    "live_state": lambda p: L.live_state(E.enrich(p)),
}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    factors = [int(x) for x in sys.argv[2:]] or [1, 10, 30]
    spark = build_session("local[8]", 8)
    events = read_events(spark, sf)
    for k in factors:
        scaled = events.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(k - 1).cast("bigint"))))
        scaled = scaled.withColumns({
            "event_id": F.col("event_id") + F.col("_copy") * 10**9,
            "user_id": F.col("user_id") + F.col("_copy") * 10**6}).drop("_copy")
        path = scratch_dir(spark, f"scale-x{k}")
        events_to_pings(scaled).repartition(max(8, 4 * k)).write.parquet(path)
        pings = spark.read.parquet(path)
        n = pings.count()
        out = {"factor": k, "pings": n}
        for name, op in OPS.items():
            df = op(pings)
            df.write.format("noop").mode("overwrite").save()  # warm-up
            t0 = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            out[name] = {"sec": round(dt, 3), "pings_per_sec": round(n / dt)}
        print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
