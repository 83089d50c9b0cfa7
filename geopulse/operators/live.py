"""Serving views: latest state per driver (S8) and the active-driver set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import ACTIVE_SET_TTL_SECS, LIVE_TTL_SECS

LIVE_FIELDS = ["latitude", "longitude", "h3_cell", "status", "speed_kmh", "event_time", "ping_id"]
LIVE_COLUMNS = ["driver_id", "latitude", "longitude", "h3_cell", "status", "speed_kmh",
                "ts_str", "event_time"]
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def iso_string(ts: Column) -> Column:
    return F.date_format(ts, ISO_MICROS)


def latest_per_driver(enriched: DataFrame) -> DataFrame:
    """Latest ping per driver by ``(event_time, ping_id)``.

    ``max_by`` over a struct key is a hash aggregate with map-side partial
    aggregation: no sort and no single task per hot driver."""
    order = F.struct(F.col("event_time"), F.col("ping_id"))
    return (enriched.filter(F.col("event_time").isNotNull())
            .groupBy("driver_id")
            .agg(F.max_by(F.struct(*LIVE_FIELDS), order).alias("s"))
            .select("driver_id", *[F.col(f"s.{c}").alias(c) for c in LIVE_FIELDS]))


def live_state(enriched: DataFrame, last_update: bool = False) -> DataFrame:
    """The cache value of every driver: position, zone, status, speed, time;
    with ``last_update`` also the processing-time stamp of the write (a clock
    column, left out of anything compared across engines)."""
    last = latest_per_driver(enriched)
    out = last.select("driver_id", "latitude", "longitude", "h3_cell", "status", "speed_kmh",
                      iso_string(F.col("event_time")).alias("ts_str"), "event_time")
    return out.withColumn("last_update", F.current_timestamp()) if last_update else out


def cache_records(enriched: DataFrame, ttl_secs: int = LIVE_TTL_SECS, versioned: bool = False) -> DataFrame:
    """What the cache stores for each driver: the key, the JSON value with its defaults
    (the write's clock stamp is added by the writer) and the seconds to live; with
    ``versioned`` also the event time and ping id that tell newer records from older."""
    value = F.to_json(F.struct(
        "driver_id", "latitude", "longitude", F.coalesce("h3_cell", F.lit("")).alias("h3_cell"), "status",
        F.coalesce("speed_kmh", F.lit(0.0)).alias("speed_kmh"), "ts_str"))
    last = latest_per_driver(enriched).withColumn("ts_str", iso_string(F.col("event_time")))
    return last.select(F.concat(F.lit("driver:"), "driver_id").alias("key"), value.alias("value"), F.lit(ttl_secs).alias("ttl_secs"),
                       *(["event_time", "ping_id"] if versioned else []))


def live_state_with_expiry(enriched: DataFrame, as_of: Column | None = None,
                           ttl_secs: int = LIVE_TTL_SECS) -> DataFrame:
    """Latest state plus ``state`` = ``EXPIRED`` when no ping came within
    ``ttl_secs`` before ``as_of`` (default: the latest event time seen)."""
    if as_of is None:
        as_of = enriched.agg(F.max("event_time")).scalar()
    expired = F.timestamp_add("SECOND", F.lit(ttl_secs), F.col("event_time")) <= as_of
    return live_state(enriched).withColumn(
        "state", F.when(expired, F.lit("EXPIRED")).otherwise(F.lit("LIVE")))


def active_drivers(pings: DataFrame, as_of: Column | None = None,
                   ttl_secs: int = ACTIVE_SET_TTL_SECS) -> DataFrame:
    """Drivers with a ping in ``(as_of - ttl, as_of]``; ``as_of`` defaults to the latest event
    time.  Then the pings are read once: the latest of all is the latest of the drivers'."""
    t = F.col("event_time")
    if as_of is not None:
        since = F.timestamp_add("SECOND", F.lit(-ttl_secs), as_of)
        return pings.filter((t > since) & (t <= as_of)).groupBy("driver_id").agg(F.max("event_time").alias("last_seen"))
    last = pings.groupBy("driver_id").agg(F.max("event_time").alias("last_seen"))
    latest = last.agg(F.max("last_seen").alias("_latest"))
    since = F.timestamp_add("SECOND", F.lit(-ttl_secs), F.col("_latest"))
    return last.join(F.broadcast(latest), F.col("last_seen") > since).select("driver_id", "last_seen")
