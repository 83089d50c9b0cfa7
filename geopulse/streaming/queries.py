"""Streaming keys: each replays the whole ``events``-derived ping table
through the streaming form of an operator and returns the sink read back.

Windowed and ordered keys flush the replay's end with markers (see ``replay``),
so their results are whole and their oracles are the batch SQL.  Active drivers are
those as of the last ping, as in the batch form.  Live state is not flushed: what the
last watermark has expired is its result.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import enrich as E
from ..operators import windows as W
from ..operators.live import ISO_MICROS
from ..plans import batch
from ..plans.oracle import (
    BRANCH_COUNTS_SQL, ORACLE_SQL, STREAM_LIVE_SQL, delivery_sql, late_data_sql, late_rows_sql,
)
from ..schema import ACTIVE_SET_TTL_SECS
from ..sinks.branch import start_branches
from ..sinks.cache import KeyedTable, versioned_records
from ..sinks.lake import read_lake, stream_to_lake
from ..sinks.monitor import DeliveryReport, counted
from ..sources import wire
from ..sources.decoded import decode_to_log, read_log
from ..sources.events import read_events
from .late import LateRows, keep_late_rows
from .replay import read_output, run_replay, run_union_replay, to_ntz
from .stateful import (
    derived_speed_from_previous, live_state_stream, previous_ping_stream, segments_stream, trip_sessions_stream,
)

CHUNKS = 4


def _replay(spark, sf_dir, build, label, **kw):
    run = run_replay(spark, batch.pings(spark, sf_dir), build, label, chunks=CHUNKS, **kw)
    return to_ntz(read_output(spark, run))


def q_stream_ping_scan(spark, sf_dir):
    return _replay(spark, sf_dir, None, "stream-scan")


def q_stream_json_decode(spark, sf_dir):
    """The ingestion path on a stream: JSON messages with rotating time
    encodings decoded by the streaming source (quarantine split off)."""
    return _replay(spark, sf_dir, wire.to_canonical, "stream-decode", wire_format=True)


def q_stream_anomalies(spark, sf_dir):
    return _replay(spark, sf_dir, lambda s: E.anomalies(E.enrich(s)), "stream-anomalies")


def q_stream_zone_occupancy(spark, sf_dir):
    return _replay(spark, sf_dir, lambda s: W.zone_occupancy(E.enrich(s)), "stream-zones", flush="time")


def q_stream_perf_metrics(spark, sf_dir):
    return _replay(spark, sf_dir, lambda s: W.perf_metrics(E.enrich(s)), "stream-metrics", flush="time")


def q_stream_perf_metrics_sliding(spark, sf_dir):
    return _replay(spark, sf_dir, lambda s: W.perf_metrics_sliding(E.enrich(s)), "stream-sliding", flush="time")


def q_stream_trip_sessions(spark, sf_dir):
    return _replay(spark, sf_dir, lambda s: trip_sessions_stream(E.enrich(s)), "stream-sessions", flush="time")


def q_stream_derived_speed(spark, sf_dir):
    return _replay(spark, sf_dir, lambda s: derived_speed_from_previous(previous_ping_stream(s)),
                   "stream-speed", flush="time")


def q_stream_trip_segments(spark, sf_dir):
    return _replay(spark, sf_dir, segments_stream, "stream-segments", flush="drivers")


def final_live_state(emitted):
    """Materialise the cache: the last emitted row per driver (an EXPIRED
    row outranks the LIVE row of the same ping)."""
    rank = F.when(F.col("state") == "EXPIRED", 1).otherwise(0)
    key = F.struct(F.col("event_time"), F.col("ping_id"), rank)
    cols = ["latitude", "longitude", "h3_cell", "status", "speed_kmh", "event_time", "state"]
    last = emitted.groupBy("driver_id").agg(F.max_by(F.struct(*cols), key).alias("s"))
    return last.select(
        "driver_id", "s.latitude", "s.longitude", "s.h3_cell", "s.status", "s.speed_kmh",
        F.date_format("s.event_time", ISO_MICROS).alias("ts_str"), "s.event_time", "s.state")


def q_stream_active_drivers(spark, sf_dir):
    """Active-driver set on a stream: the live state with a 300 s expiry, the watermark moved
    to the last ping; as of that ping, the drivers that have not expired are active."""
    emitted = _replay(spark, sf_dir,
                      lambda s: live_state_stream(E.enrich(s), ttl_secs=ACTIVE_SET_TTL_SECS),
                      "stream-active", flush="last")
    final = final_live_state(emitted)
    last = final.agg(F.max("event_time").alias("as_of"))
    # timers tick in milliseconds: the set is cut at the microsecond
    return final.join(F.broadcast(last), F.col("event_time") > F.timestamp_add("SECOND", F.lit(-ACTIVE_SET_TTL_SECS), "as_of")) \
        .filter(F.col("state") == "LIVE").select("driver_id", F.col("event_time").alias("last_seen"))


def q_stream_live_state(spark, sf_dir):
    emitted = _replay(spark, sf_dir, lambda s: live_state_stream(E.enrich(s)), "stream-live")
    return final_live_state(emitted)


LATE_ORDER = [0, 2, 1, 3]


def q_stream_late_data(spark, sf_dir):
    """Zone occupancy with the second time chunk delivered after the third:
    by then the watermark has passed every window of the late chunk, so its
    rows are dropped (counted in ``numRowsDroppedByWatermark``) and the result
    equals the batch query over the other chunks."""
    return _replay(spark, sf_dir, lambda s: W.zone_occupancy(E.enrich(s)), "stream-late",
                   order=LATE_ORDER, flush="time")


def q_stream_late_rows(spark, sf_dir):
    """The pings that arrive behind the watermark, kept: the late chunk of ``stream_late_data``."""
    holder = {}

    def writer(stream, run):
        holder["late"] = LateRows(run.output)
        return keep_late_rows(stream, run.output, run.checkpoint)

    run_replay(spark, batch.pings(spark, sf_dir), None, "stream-late-rows", chunks=CHUNKS, order=LATE_ORDER, writer=writer)
    return to_ntz(holder["late"].rows(spark))


#: The second source of the union runs this far behind the first.
SOURCE_LAG_US = 40_000_000


def two_sources(pings):
    """A fleet reporting over two feeds, by driver."""
    second = F.pmod(F.xxhash64("driver_id"), F.lit(2)) == 1
    return [pings.where(~second | F.col("driver_id").isNull()), pings.where(second)]


def q_stream_union_sources(spark, sf_dir):
    """Zone occupancy over two feeds with watermarks of their own, one 40 s behind the other."""
    run = run_union_replay(spark, two_sources(batch.pings(spark, sf_dir)), lambda s: W.zone_occupancy(E.enrich(s)),
                           "stream-union", [0, SOURCE_LAG_US], chunks=CHUNKS)
    return to_ntz(read_output(spark, run))


def q_stream_wire_zones(spark, sf_dir):
    """Zone occupancy from JSON messages: decoded, windowed and flushed by end messages."""
    return _replay(spark, sf_dir, lambda s: W.zone_occupancy(E.enrich(s)), "stream-wire-zones", wire_format=True, flush="time")


def _log_reader(run):
    return f"{run.base}/log"


def q_branch_counts(spark, sf_dir):
    """Replay the messages into the decoded log and the log into the three branches, then
    count what each sink holds: lake rows, cached drivers, anomaly rows."""
    holder = {}

    def writer(messages, run):
        session = messages.sparkSession
        decode_to_log(messages, _log_reader(run), f"{run.checkpoint}-decode").trigger(availableNow=True).start().awaitTermination()
        pings, _ = read_log(session, _log_reader(run))
        queries, side = start_branches(E.enrich(pings), run.output, {"availableNow": True})
        holder["side"], holder["base"] = side, run.output
        return queries

    ping_rows = batch.pings(spark, sf_dir)
    run_replay(spark, ping_rows, None, "stream-branch", chunks=CHUNKS, writer=writer, raw=True)
    side, base = holder["side"], holder["base"]
    schema = E.enrich(ping_rows).schema
    lake_rows = read_lake(spark, base + "/lake", schema)
    counts = [
        lake_rows.select(F.lit("lake").alias("branch")),
        side.store.read(spark).select(F.lit("cache").alias("branch")),
        side.all_anomalies(spark).select(F.lit("anomalies").alias("branch")),
    ]
    u = counts[0].unionByName(counts[1]).unionByName(counts[2])
    return u.groupBy("branch").agg(F.count(F.lit(1)).alias("records"))


def q_cache_upserts(spark, sf_dir):
    """The cache after batches that arrive out of order: versioned upserts into a keyed table."""
    holder = {}

    def writer(stream, run):
        table = holder["table"] = KeyedTable(f"{run.output}/cache")
        return (stream.writeStream.foreachBatch(lambda b, i: table.upsert(versioned_records(b), i))
                .option("checkpointLocation", run.checkpoint))

    run_replay(spark, batch.pings(spark, sf_dir), E.enrich, "cache-upserts", chunks=CHUNKS, order=LATE_ORDER, writer=writer)
    return holder["table"].read(spark).select("key", "value", "ttl_secs")


def q_delivery_report(spark, sf_dir):
    """What a replay delivered, from metrics observed as the rows passed: messages read, decoded and
    quarantined, pings written to the lake, and pings that came behind the watermark (one chunk does)."""
    report, holder = DeliveryReport(), {}

    def writer(messages, run):
        session = messages.sparkSession
        decode = decode_to_log(messages, _log_reader(run), f"{run.checkpoint}-decode").trigger(availableNow=True).start()
        decode.awaitTermination()
        pings, _ = read_log(session, _log_reader(run))
        holder["late"] = LateRows(f"{run.output}/late")
        outputs = [stream_to_lake(counted(E.enrich(pings)), f"{run.output}/lake", f"{run.checkpoint}-lake").trigger(availableNow=True).start(),
                   keep_late_rows(pings, f"{run.output}/late", f"{run.checkpoint}-late").trigger(availableNow=True).start()]
        for q in [decode, *outputs]:
            q.awaitTermination()
            for p in q.recentProgress:
                report.record(p)
        return outputs

    pings = batch.pings(spark, sf_dir)
    foreign = read_events(spark, sf_dir).select(F.col("props").alias("value"))  # no event time
    run_replay(spark, pings, None, "delivery", chunks=CHUNKS, order=LATE_ORDER, writer=writer, raw=True, more_messages=foreign)
    counts = [(m, report.total(m)) for m in ("read", "decoded", "quarantined", "written")]
    late = holder["late"].rows(spark).agg(F.lit("late").alias("metric"), F.count("*").alias("records"))
    return spark.createDataFrame(counts, "metric string, records long").unionByName(late)


STREAM_QUERIES = {
    "stream_ping_scan": q_stream_ping_scan,
    "stream_json_decode": q_stream_json_decode,
    "stream_anomalies": q_stream_anomalies,
    "stream_zone_occupancy": q_stream_zone_occupancy,
    "stream_perf_metrics": q_stream_perf_metrics,
    "stream_perf_metrics_sliding": q_stream_perf_metrics_sliding,
    "stream_trip_sessions": q_stream_trip_sessions,
    "stream_derived_speed": q_stream_derived_speed,
    "stream_trip_segments": q_stream_trip_segments,
    "stream_live_state": q_stream_live_state,
    "stream_active_drivers": q_stream_active_drivers,
    "stream_late_data": q_stream_late_data,
    "stream_late_rows": q_stream_late_rows,
    "stream_union_sources": q_stream_union_sources,
    "stream_wire_zones": q_stream_wire_zones,
    "branch_counts": q_branch_counts,
    "cache_upserts": q_cache_upserts,
    "delivery_report": q_delivery_report,
}

STREAM_ORACLES = {
    "stream_ping_scan": ORACLE_SQL["ping_scan"],
    "stream_json_decode": ORACLE_SQL["json_decode"],
    "stream_anomalies": ORACLE_SQL["anomalies"],
    "stream_zone_occupancy": ORACLE_SQL["zone_occupancy"],
    "stream_perf_metrics": ORACLE_SQL["perf_metrics"],
    "stream_perf_metrics_sliding": ORACLE_SQL["perf_metrics_sliding"],
    "stream_trip_sessions": ORACLE_SQL["trip_sessions"],
    "stream_derived_speed": ORACLE_SQL["derived_speed"],
    "stream_trip_segments": ORACLE_SQL["trip_segments"],
    "stream_live_state": STREAM_LIVE_SQL,
    "stream_active_drivers": ORACLE_SQL["active_drivers"],
    "stream_late_data": late_data_sql(LATE_ORDER, CHUNKS),
    "stream_late_rows": late_rows_sql(LATE_ORDER, CHUNKS),
    "stream_union_sources": ORACLE_SQL["zone_occupancy"],
    "stream_wire_zones": ORACLE_SQL["zone_occupancy"],
    "branch_counts": BRANCH_COUNTS_SQL,
    "cache_upserts": ORACLE_SQL["cache_records"],
    "delivery_report": delivery_sql(LATE_ORDER, CHUNKS),
}
