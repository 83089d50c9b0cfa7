"""Batch queries over the driver's tables: one callable per SURVEY §2 key.

Each takes ``(spark, sf_dir)``, reads the whole ``events`` table through the
ping adapter and returns a DataFrame with flat, aliased columns (no clock
columns such as ``processing_time``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import enrich as E
from ..operators import live as L
from ..operators import trips as TR
from ..operators import windows as W
from ..functions.exprs import parse_event_time
from ..session import ensure_utc, scratch_dir
from ..sinks import lake
from ..sources import wire
from ..sources.events import load_pings, read_events
from .sql_surface import sql_zone_occupancy


def pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return load_pings(spark, sf_dir)


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.enrich(pings(spark, sf_dir))


# ---- ingest ---------------------------------------------------------------

def q_ping_scan(spark, sf_dir):
    return pings(spark, sf_dir)


def q_json_decode(spark, sf_dir):
    msgs = wire.encode_mixed(pings(spark, sf_dir)).select("value")
    return wire.to_canonical(wire.decode(msgs)).withColumn(
        "event_time", F.col("event_time").cast("timestamp_ntz"))


def q_json_quarantine(spark, sf_dir):
    """Wire messages of every ping plus, on the same topic, messages that can't be used, foreign JSON (the
    events' ``props`` documents: no event time) and non-JSON text (each
    document with its braces turned into parentheses)."""
    ensure_utc(spark)
    msgs = wire.encode_mixed(pings(spark, sf_dir)).select("value")
    props = read_events(spark, sf_dir).select("props")
    foreign = props.select(F.col("props").alias("value"))
    garbled = props.select(F.translate("props", "{}", "()").alias("value"))
    everything = msgs.unionByName(foreign).unionByName(garbled)
    ids = read_events(spark, sf_dir).select(F.col("event_id").cast("string").alias("id"))
    for body, _ in wire.UNUSABLE_MESSAGES:
        everything = everything.unionByName(ids.select(
            F.concat(F.lit("{" + body + ', "ping_id": '), "id", F.lit("}")).alias("value")))
    return wire.quarantine(everything)


def q_event_time_parse(spark, sf_dir):
    p = pings(spark, sf_dir)
    t = F.col("event_time").cast("timestamp")
    iso = F.date_format(t, wire.ISO_MICROS)
    millis = F.unix_millis(t).cast("string")
    return p.select(
        "ping_id",
        parse_event_time(iso, F.lit(None).cast("string")).cast("timestamp_ntz").alias("from_ts_str"),
        parse_event_time(F.lit(None).cast("string"), iso).cast("timestamp_ntz").alias("from_iso"),
        parse_event_time(F.lit(None).cast("string"), millis).cast("timestamp_ntz").alias("from_millis"))


def q_ping_encode(spark, sf_dir):
    return wire.encode(pings(spark, sf_dir), "iso")


def q_ping_limit(spark, sf_dir):
    """Five rows of the enriched pings, found again in the whole relation and counted."""
    e = enriched(spark, sf_dir)
    some = e.limit(5).select("ping_id")
    return e.join(some, "ping_id", "left_semi").agg(F.count("*").alias("records"))


# ---- enrich ---------------------------------------------------------------

def q_enriched(spark, sf_dir):
    return enriched(spark, sf_dir)


def q_hex_cell(spark, sf_dir):
    return enriched(spark, sf_dir).select("ping_id", "latitude", "longitude", "h3_cell")


def q_anomaly_flags(spark, sf_dir):
    return enriched(spark, sf_dir).select("ping_id", "speed_kmh", "status", "anomaly_type")


def q_trip_category(spark, sf_dir):
    return enriched(spark, sf_dir).select("ping_id", "trip_duration_secs", "trip_category")


def q_on_trip_pings(spark, sf_dir):
    return W.on_trip_pings(pings(spark, sf_dir))


def q_anomalies(spark, sf_dir):
    return E.anomalies(enriched(spark, sf_dir))


def q_processing_stamps(spark, sf_dir):
    """The processing-time stamps: every enriched ping and every anomaly has one, the same for the whole query
    and later than the ping."""
    e = E.enrich(pings(spark, sf_dir), processing_time=True)
    now = F.current_timestamp()
    late = lambda stamp, t: (F.col(stamp) == now) & (F.col(stamp) > F.col(t).cast("timestamp"))
    stamped = e.select(F.lit("ping").alias("relation"), late("processing_time", "event_time").alias("stamped"))
    found = E.anomalies(e, detected_at=True).select(F.lit("anomaly").alias("relation"), late("detected_at", "anomaly_time").alias("stamped"))
    return stamped.unionByName(found).groupBy("relation").agg(F.count("*").alias("records"), F.count_if("stamped").alias("stamped"))


def q_zone_counts(spark, sf_dir):
    return E.zone_counts(enriched(spark, sf_dir))


def q_sql_over_view(spark, sf_dir):
    return sql_zone_occupancy(spark, pings(spark, sf_dir))


# ---- windows --------------------------------------------------------------

def q_zone_occupancy(spark, sf_dir):
    return W.zone_occupancy(enriched(spark, sf_dir))


def q_perf_metrics(spark, sf_dir):
    return W.perf_metrics(enriched(spark, sf_dir))


def q_perf_metrics_sliding(spark, sf_dir):
    return W.perf_metrics_sliding(enriched(spark, sf_dir))


def q_trip_sessions(spark, sf_dir):
    return W.trip_sessions(enriched(spark, sf_dir))


# ---- trips ----------------------------------------------------------------

def q_haversine(spark, sf_dir):
    return TR.haversine_legs(pings(spark, sf_dir))


def q_derived_speed(spark, sf_dir):
    return TR.derived_speed(pings(spark, sf_dir))


def q_trip_segments(spark, sf_dir):
    return TR.trip_segments(pings(spark, sf_dir))


# ---- serving --------------------------------------------------------------

def q_live_state(spark, sf_dir):
    return L.live_state(enriched(spark, sf_dir))


def q_cache_records(spark, sf_dir):
    return L.cache_records(enriched(spark, sf_dir))


def q_active_drivers(spark, sf_dir):
    return L.active_drivers(pings(spark, sf_dir))


def _lake_written(spark, sf_dir) -> tuple[str, DataFrame]:
    e = enriched(spark, sf_dir)
    path = scratch_dir(spark, "lake")
    lake.write_lake(e, path)
    return path, lake.read_lake(spark, path, e.schema)


def q_lake_partitions(spark, sf_dir):
    _, back = _lake_written(spark, sf_dir)
    return lake.partition_counts(back)


def q_lake_roundtrip(spark, sf_dir):
    _, back = _lake_written(spark, sf_dir)
    return back


BATCH_QUERIES = {
    "ping_scan": q_ping_scan,
    "json_decode": q_json_decode,
    "json_quarantine": q_json_quarantine,
    "event_time_parse": q_event_time_parse,
    "ping_encode": q_ping_encode,
    "ping_limit": q_ping_limit,
    "enriched": q_enriched,
    "hex_cell": q_hex_cell,
    "anomaly_flags": q_anomaly_flags,
    "trip_category": q_trip_category,
    "on_trip_pings": q_on_trip_pings,
    "anomalies": q_anomalies,
    "processing_stamps": q_processing_stamps,
    "zone_counts": q_zone_counts,
    "sql_over_view": q_sql_over_view,
    "zone_occupancy": q_zone_occupancy,
    "perf_metrics": q_perf_metrics,
    "perf_metrics_sliding": q_perf_metrics_sliding,
    "trip_sessions": q_trip_sessions,
    "haversine": q_haversine,
    "derived_speed": q_derived_speed,
    "trip_segments": q_trip_segments,
    "live_state": q_live_state,
    "cache_records": q_cache_records,
    "active_drivers": q_active_drivers,
    "lake_partitions": q_lake_partitions,
    "lake_roundtrip": q_lake_roundtrip,
}
