"""Adapter from the driver-generated ``events`` table to canonical pings.

Raw events are too sparse for 30-second windows, so time is compressed
120-fold around 2024-01-01 with integer microseconds.  Every expression is
plain Spark SQL and zone-independent (TIMESTAMP_NTZ arithmetic), and the
DuckDB oracle in ``geopulse.plans.oracle`` writes the same formulas.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import PING_COLUMNS, STATUS_AVAILABLE, STATUS_ON_TRIP

# Fixed values of the adapter (FIXTURES §5).
TIME_ORIGIN_NTZ = "2024-01-01 00:00:00"
TIME_COMPRESSION = 120
CENTER_LAT = 28.6139
CENTER_LON = 77.2090
ON_TRIP_EVENT_TYPES = ("click", "view", "purchase")
NEGATIVE_SPEED_EVERY = 97
DURATION_SCALE = 12

EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, "events")).select(*EVENT_COLUMNS)


def compressed_time(ts: Column) -> Column:
    origin = F.lit(TIME_ORIGIN_NTZ).cast("timestamp_ntz")
    offset = F.timestamp_diff("MICROSECOND", origin, ts)
    return F.timestamp_add("MICROSECOND", F.call_function("div", offset, F.lit(TIME_COMPRESSION)), origin)


def events_to_pings(events: DataFrame) -> DataFrame:
    """Map ``events`` rows to the canonical ping schema (event_time NTZ)."""
    e = events
    lat = F.lit(CENTER_LAT) + (((F.col("event_id") * 7919) % 3) - 1).cast("double") / 100.0
    lon = F.lit(CENTER_LON) + (((F.col("user_id") * 104729) % 3) - 1).cast("double") / 100.0
    status = (F.when(F.col("event_type").isin(*ON_TRIP_EVENT_TYPES), F.lit(STATUS_ON_TRIP))
              .otherwise(F.lit(STATUS_AVAILABLE)))
    speed = (F.when(F.col("event_id") % NEGATIVE_SPEED_EVERY == 0, -F.col("value"))
             .otherwise(F.col("value")))
    duration = F.get_json_object("props", "$.k").cast("int") * DURATION_SCALE
    return e.select(
        F.col("event_id").alias("ping_id"),
        F.concat(F.lit("DRV_"), F.col("user_id").cast("string")).alias("driver_id"),
        lat.alias("latitude"),
        lon.alias("longitude"),
        status.alias("status"),
        speed.alias("speed_kmh"),
        duration.alias("trip_duration_secs"),
        compressed_time(F.col("ts")).alias("event_time"),
        F.date_format(compressed_time(F.col("ts")), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts_str"),
        # as a payload would report it: the speed over the trip so far
        (F.abs("value") * duration / F.lit(3600.0)).alias("trip_distance_km"),
    )


def load_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical pings over the whole ``events`` table of ``sf_dir``."""
    return events_to_pings(read_events(spark, sf_dir)).select(*PING_COLUMNS)


def to_stream_time(pings: DataFrame) -> DataFrame:
    """Streams carry ``timestamp`` (session zone UTC) rather than NTZ."""
    return pings.withColumn("event_time", F.col("event_time").cast("timestamp"))
