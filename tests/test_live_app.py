"""End to end: JSON wire files → decode/quarantine → every output running."""
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from geopulse.operators import enrich as E
from geopulse.operators import windows as W
from geopulse.plans import batch
from geopulse.plans.live_app import await_all, start_live_app
from geopulse.session import scratch_dir
from geopulse.sources import files, kafka, wire
from geopulse.sources.events import read_events

SF = "/root/testdata/sf0.001"


def test_live_app_from_wire_files(spark):
    base = scratch_dir(spark, "t-live-app")
    landing = base + "/landing"
    msgs = wire.encode_mixed(batch.pings(spark, SF)).select("value")
    foreign = read_events(spark, SF).select(F.col("props").alias("value"))
    msgs.unionByName(foreign).write.text(landing)

    messages = files.read_message_stream(spark, landing)
    started = start_live_app(spark, messages, base + "/out", trigger={"availableNow": True}, print_zones=True)
    report = started["_report"]
    try:
        await_all(started)
    finally:
        time.sleep(1)
        spark.streams.removeListener(report)

    good_b, bad_b = files.read_wire_batch(spark, landing)
    # each message was read and decoded once, however many outputs there are
    total = msgs.count() + foreign.count()
    assert report.total("read") == report.total("input_rows", "geopulse_decode") == total
    assert (report.total("decoded"), report.total("quarantined")) == (good_b.count(), bad_b.count())
    assert report.total("written", "geopulse_quarantine") == bad_b.count() and len(report.batches) <= 100
    assert spark.read.parquet(base + "/out/quarantine").count() == bad_b.count() == foreign.count()
    # zone windows: stream = batch cut at the final watermark
    cut = good_b.agg(F.max("event_time")).first()[0]
    import datetime as dt
    wm = cut - dt.timedelta(seconds=10)
    expected = W.zone_occupancy(E.enrich(good_b)).filter(F.col("window_end") <= F.lit(wm))
    got = spark.read.parquet(base + "/out/zone_occupancy")
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0
    for name in ("anomalies", "trip_sessions", "perf_metrics", "perf_metrics_sliding", "live_state", "active_drivers",
                 "derived_speed", "trip_segments"):
        assert spark.read.parquet(f"{base}/out/{name}").count() > 0, name
    lake_rows = spark.read.text(base + "/out/branches/lake").count()
    assert lake_rows == good_b.count()
    assert spark.read.parquet(base + "/out/anomalies").where("detected_at is null").count() == 0
    assert spark.read.parquet(base + "/out/late/rows").count() == 0


def test_kafka_options():
    o = kafka.source_options("broker:9092", "gps_pings", "earliest", max_offsets_per_trigger=100,
                             group_id="g")
    assert o["subscribe"] == "gps_pings" and o["startingOffsets"] == "earliest"
    assert o["maxOffsetsPerTrigger"] == "100" and o["kafka.group.id"] == "g"
    assert kafka.sink_options("b:1", "t")["topic"] == "t"


def test_kafka_source_needs_connector(spark):
    try:
        pings, _ = kafka.read_pings(spark, "localhost:1", "gps_pings")
    except AnalysisException as e:
        assert "kafka" in str(e).lower()
    else:  # connector present: the stream is defined with a watermark
        assert pings.isStreaming


def test_command_line_live_app(spark):
    """``python -m geopulse --files ... --available-now`` over wire files."""
    from geopulse.__main__ import main
    base = scratch_dir(spark, "t-cli")
    wire.encode_mixed(batch.pings(spark, SF)).select("value").write.text(base + "/landing")
    main(["--files", base + "/landing", "--out", base + "/out", "--available-now",
          "--outputs", "zone_occupancy,anomalies", "--max-files-per-trigger", "1"])
    assert spark.read.parquet(base + "/out/zone_occupancy").count() > 0
    assert spark.read.parquet(base + "/out/anomalies").count() > 0
    assert spark.read.text(base + "/out/branches/lake").count() == 1000
