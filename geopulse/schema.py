"""Canonical schemas of the ping relation and its derived tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Canonical ping (FIXTURES §3).  ``ts_str`` is the time as the message wrote it.  ``ping_id`` is the tie-break for rows of a
# driver that share an event time.
PING_COLUMNS = [
    "ping_id", "driver_id", "latitude", "longitude", "status", "speed_kmh",
    "trip_duration_secs", "event_time", "ts_str", "trip_distance_km",
]

PING_SCHEMA = T.StructType([
    T.StructField("ping_id", T.LongType()),
    T.StructField("driver_id", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("speed_kmh", T.DoubleType()),
    T.StructField("trip_duration_secs", T.IntegerType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("ts_str", T.StringType()),
    T.StructField("trip_distance_km", T.DoubleType()),
])

# Wire format of one JSON message.  Every time encoding the producers use is
# declared as a string so that none of them nulls the others out: an ISO
# string in ``timestamp``, an ISO string in ``ts_str``, epoch milliseconds in
# ``timestamp``.  ``trip_duration_sec`` is the second script's spelling.
WIRE_SCHEMA = T.StructType([
    T.StructField("ping_id", T.LongType()),
    T.StructField("driver_id", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("speed_kmh", T.DoubleType()),
    T.StructField("trip_duration_secs", T.IntegerType()),
    T.StructField("trip_duration_sec", T.IntegerType()),
    T.StructField("trip_distance_km", T.DoubleType()),
    T.StructField("ts_str", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])

ENRICHED_EXTRA = ["h3_cell", "anomaly_type", "trip_category"]

# Fixed values of the reference: status labels and anomaly labels.
STATUS_AVAILABLE = "available"
STATUS_ON_TRIP = "on_trip"
ANOMALY_NEGATIVE = "NEGATIVE_SPEED"
ANOMALY_IMPOSSIBLE = "IMPOSSIBLE_SPEED"
ANOMALY_NORMAL = "NORMAL"

# Fixed values of the reference: thresholds and intervals.
IMPOSSIBLE_SPEED_KMH = 120
SHORT_TRIP_SECS = 300
MEDIUM_TRIP_SECS = 900
WATERMARK_DELAY = "10 seconds"
ZONE_WINDOW = "30 seconds"
METRIC_WINDOW = "1 minute"
METRIC_SLIDE = "10 seconds"
SESSION_GAP = "5 minutes"
LIVE_TTL_SECS = 60
ACTIVE_SET_TTL_SECS = 300
HEX_RESOLUTION = 9
LAKE_RECORDS_PER_OBJECT = 100
