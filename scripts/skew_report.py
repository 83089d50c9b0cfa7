"""Per-stage task skew from Spark's event log, for a hot-driver workload.

Usage: python scripts/skew_report.py [sf_dir] [hot_share_mod]
Remaps every ``hot_share_mod``-th ping (default 3: a third of all rows) to one
driver, runs each sequence operator and, for comparison, a plain window over
each driver's whole history, with the event log in a fresh scratch folder.
Prints, per query, the stage whose tasks read the most shuffle records:
task count and max / median records per task.
"""
from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from geopulse.operators import enrich as E  # noqa: E402
from geopulse.operators import trips as TR  # noqa: E402
from geopulse.operators import windows as W  # noqa: E402
from geopulse.plans import batch  # noqa: E402
from geopulse.session import build_session  # noqa: E402


def _log_files(logdir: str) -> list[str]:
    out = []
    for root, _dirs, names in os.walk(logdir):
        out += [os.path.join(root, n) for n in names if n.startswith("events") or n.startswith("local")]
    return sorted(out)


def _lines(path: str):
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as fh:
            data = zstandard.ZstdDecompressor().stream_reader(fh).read()
        yield from data.decode().splitlines()
    else:
        with open(path) as fh:
            yield from fh


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    mod = int(sys.argv[2]) if len(sys.argv) > 2 else 3
    logdir = tempfile.mkdtemp(prefix="run-eventlog-")
    spark = build_session("local[8]", 16, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{logdir}",
        "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    hot = batch.pings(spark, sf).withColumn(
        "driver_id", F.when(F.col("ping_id") % mod == 0, F.lit("DRV_HOT")).otherwise(F.col("driver_id")))
    naive_w = Window.partitionBy("driver_id").orderBy("event_time", "ping_id")
    jobs = {
        "plain window per driver": hot.withColumn("p", F.lag("latitude").over(naive_w)),
        "derived_speed (time-salted)": TR.derived_speed(hot),
        "trip_segments (time-salted)": TR.trip_segments(hot),
        "trip_sessions (bucketed)": W.trip_sessions(E.enrich(hot)),
        "zone_occupancy": W.zone_occupancy(E.enrich(hot)),
    }
    for name, df in jobs.items():
        spark.sparkContext.setJobGroup(name, name)
        df.write.format("noop").mode("overwrite").save()
    spark.stop()

    stage_job, job_group, tasks = {}, {}, {}
    for path in _log_files(logdir):
        for line in _lines(path):
            if True:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_job[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    rec = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    tasks.setdefault(ev["Stage ID"], []).append(rec)
    report = {}
    for sid, recs in tasks.items():
        group = stage_job.get(sid)
        if group is None or max(recs) == 0:
            continue
        best = report.get(group)
        if best is None or max(recs) > best["max_records_per_task"]:
            report[group] = {"stage": sid, "tasks": len(recs), "max_records_per_task": max(recs),
                             "median_records_per_task": statistics.median(recs)}
    print(json.dumps({"sf": sf, "hot_share": f"1/{mod}", "event_log": logdir, "stages": report}, indent=1))


if __name__ == "__main__":
    main()
