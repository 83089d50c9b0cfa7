"""DuckDB SQL equivalents of the registered queries (the correctness gate).

Written directly over the driver's views; the ping adapter is one shared CTE
(``FIXTURES.md`` §5).  Sequences use window functions over each driver's
whole history and sessions use the plain lag rule, i.e. the straightforward
formulations the Spark operators are checked against.
"""

from __future__ import annotations

from ..sources.events import (
    CENTER_LAT, CENTER_LON, DURATION_SCALE, NEGATIVE_SPEED_EVERY, TIME_COMPRESSION,
)
from ..sources.wire import UNUSABLE_MESSAGES
from .sqltext import dbl

ORIGIN_US = 1704067200000000  # 2024-01-01 00:00:00 UTC in microseconds

# The formulas below are written for DuckDB on their own, not shared with the Spark side.

def _mean(column: str) -> str:
    """Two-digit mean of a column of two-digit numbers, ties away from zero, in integers."""
    total, n = f"sum(CAST(round({column} * 100) AS HUGEINT))", f"count({column})"
    return (f"CASE WHEN {n} = 0 THEN NULL WHEN {total} >= 0 THEN (2 * {total} + {n}) // (2 * {n}) / 100e0 "
            f"ELSE -((2 * -{total} + {n}) // (2 * {n})) / 100e0 END")


def _percent(condition: str) -> str:
    part = f"CAST(count(*) FILTER ({condition}) AS HUGEINT)"
    return f"((2 * 10000 * {part} + count(*)) // (2 * count(*))) / 100e0"


def _haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """2 R asin(sqrt(sin²(dφ/2) + cos φ1 cos φ2 sin²(dλ/2))), R = 6371; NULL without a first point."""
    rad = lambda v: f"({v} * 0.017453292519943295)"
    a = (f"pow(sin(({rad(lat2)} - {rad(lat1)}) / 2), 2) + cos({rad(lat1)}) * cos({rad(lat2)}) "
         f"* pow(sin(({rad(lon2)} - {rad(lon1)}) / 2), 2)")
    missing = " OR ".join(f"{v} IS NULL" for v in (lat1, lon1, lat2, lon2))
    return f"(CASE WHEN {missing} THEN NULL ELSE 2 * 6371 * asin(sqrt(CASE WHEN {a} > 1 THEN 1 ELSE {a} END)) END)"


_ANOMALY = ("CASE WHEN speed_kmh < 0 THEN 'NEGATIVE_SPEED' WHEN speed_kmh > 120 AND status = 'available' "
            "THEN 'IMPOSSIBLE_SPEED' WHEN speed_kmh IS NOT NULL THEN 'NORMAL' END")
_CATEGORY = ("CAST(CASE WHEN trip_duration_secs = 0 THEN 0 WHEN trip_duration_secs < 300 THEN 1 "
             "WHEN trip_duration_secs < 900 THEN 2 WHEN trip_duration_secs >= 900 THEN 3 END AS BIGINT)")

PING_COLS = "ping_id, driver_id, latitude, longitude, status, speed_kmh, trip_duration_secs, event_time, ts_str, trip_distance_km"

PINGS_CTE = f"""
pings AS (
    SELECT event_id AS ping_id,
           concat('DRV_', CAST(user_id AS VARCHAR)) AS driver_id,
           {dbl(CENTER_LAT)} + CAST((event_id * 7919) % 3 - 1 AS DOUBLE) / 100e0 AS latitude,
           {dbl(CENTER_LON)} + CAST((user_id * 104729) % 3 - 1 AS DOUBLE) / 100e0 AS longitude,
           CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'on_trip' ELSE 'available' END AS status,
           CASE WHEN event_id % {NEGATIVE_SPEED_EVERY} = 0 THEN -value ELSE value END AS speed_kmh,
           CAST(json_extract(props, '$.k') AS INTEGER) * {DURATION_SCALE} AS trip_duration_secs,
           make_timestamp({ORIGIN_US} + (epoch_us(ts) - {ORIGIN_US}) // {TIME_COMPRESSION}) AS event_time,
           strftime(make_timestamp({ORIGIN_US} + (epoch_us(ts) - {ORIGIN_US}) // {TIME_COMPRESSION}), '%Y-%m-%dT%H:%M:%S.%f') AS ts_str,
           abs(value) * (CAST(json_extract(props, '$.k') AS INTEGER) * {DURATION_SCALE}) / 3600e0 AS trip_distance_km
    FROM events
),
axial AS (  -- fractional axial coordinates in edges of a hexagon of 105,332.513 m2, around latitude 28.6139
    SELECT *, (sqrt(3) * metres_x - metres_y) / (3 * edge) AS q, 2 * metres_y / (3 * edge) AS r
    FROM (SELECT *, longitude * 6371000 * radians(1) * cos(radians(28.6139e0)) AS metres_x, latitude * 6371000 * radians(1) AS metres_y,
                 sqrt(105332.513e0 * 2 / (3 * sqrt(3))) AS edge
          FROM pings)
),
enriched AS (
    SELECT {PING_COLS},
           -- the nearest centre: round both, then move the one that was rounded further by what is left over
           CASE WHEN latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 THEN 'hx_'
                || CAST(round(q) + CASE WHEN abs(q - round(q)) >= abs(r - round(r)) THEN round(q - round(q) + (r - round(r)) / 2) ELSE 0 END AS BIGINT) || '_'
                || CAST(round(r) + CASE WHEN abs(q - round(q)) < abs(r - round(r)) THEN round(r - round(r) + (q - round(q)) / 2) ELSE 0 END AS BIGINT) END AS h3_cell,
           {_ANOMALY} AS anomaly_type,
           {_CATEGORY} AS trip_category
    FROM axial
)"""

ENRICHED_COLS = PING_COLS + ", h3_cell, anomaly_type, trip_category"


def _with(body: str, extra_ctes: str = "") -> str:
    ctes = PINGS_CTE + ("," + extra_ctes if extra_ctes else "")
    return f"WITH {ctes}\n{body}"


def _bucket(us: int, col: str = "event_time") -> str:
    return f"make_timestamp((epoch_us({col}) // {us}) * {us})"


def zone_sql(source: str = "enriched", extra_ctes: str = "") -> str:
    return _with(f"""
SELECT {_bucket(30_000_000)} AS window_start,
       {_bucket(30_000_000)} + INTERVAL 30 SECOND AS window_end,
       h3_cell, status,
       count(*) AS ping_count,
       count(DISTINCT driver_id) AS unique_drivers,
       {_mean('speed_kmh')} AS avg_speed,
       round(max(speed_kmh), 2) AS max_speed,
       round(min(speed_kmh), 2) AS min_speed,
       CAST(count_if(status = 'on_trip') AS BIGINT) AS on_trip_count,
       {_percent("status = 'on_trip'")} AS on_trip_percentage
FROM {source} WHERE event_time IS NOT NULL
GROUP BY ALL""", extra_ctes)


ZONE_SQL = zone_sql()

_METRICS = f"""
       count(*) AS total_events,
       count(DISTINCT driver_id) AS active_drivers,
       count(DISTINCT h3_cell) AS active_zones,
       CAST(count_if(status = 'on_trip') AS BIGINT) AS trips_count,
       CAST(count_if(anomaly_type <> 'NORMAL') AS BIGINT) AS anomalies_count,
       {_percent("anomaly_type <> 'NORMAL'")} AS anomaly_rate_percent"""

PERF_SQL = _with(f"""
SELECT {_bucket(60_000_000)} AS metric_window, {_METRICS}
FROM enriched WHERE event_time IS NOT NULL
GROUP BY 1""")

SLIDING_SQL = _with(f"""
SELECT window_start, window_start + INTERVAL 1 MINUTE AS window_end, {_METRICS}
FROM (SELECT *, make_timestamp((epoch_us(event_time) // 10000000 - k) * 10000000) AS window_start
      FROM (SELECT *, unnest(range(6)) AS k FROM enriched WHERE event_time IS NOT NULL))
GROUP BY 1""")

SESSIONS_SQL = _with(f"""
SELECT driver_id,
       min(event_time) AS trip_start,
       max(event_time) + INTERVAL 5 MINUTE AS trip_end,
       count(*) AS total_pings,
       {_mean('speed_kmh')} AS avg_speed_during_trip,
       round(max(latitude), 6) AS max_latitude,
       round(max(longitude), 6) AS max_longitude,
       round(min(latitude), 6) AS min_latitude,
       round(min(longitude), 6) AS min_longitude,
       count(DISTINCT h3_cell) AS h3_cells_visited,
       max(trip_duration_secs) AS max_trip_duration
FROM (SELECT *, sum(nw) OVER (PARTITION BY driver_id ORDER BY t
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
      FROM (SELECT *, CASE WHEN lag(t) OVER (PARTITION BY driver_id ORDER BY t) IS NULL
                            OR t - lag(t) OVER (PARTITION BY driver_id ORDER BY t) > 300000000
                           THEN 1 ELSE 0 END AS nw
            FROM (SELECT *, epoch_us(event_time) AS t FROM enriched
                  WHERE status = 'on_trip' AND event_time IS NOT NULL)))
GROUP BY driver_id, sid""")

_LAGGED = f"""
lagged AS (
    SELECT *, epoch_us(event_time) AS t,
           lag(latitude) OVER w AS plat, lag(longitude) OVER w AS plon,
           lag(status) OVER w AS pstatus, lag(epoch_us(event_time)) OVER w AS pt,
           lag(ping_id) OVER w AS pid
    FROM pings WHERE event_time IS NOT NULL
    WINDOW w AS (PARTITION BY driver_id ORDER BY event_time, ping_id)
)"""

HAV = _haversine("plat", "plon", "latitude", "longitude")

HAVERSINE_SQL = _with(f"""
SELECT ping_id, driver_id, event_time, round({HAV}, 6) AS distance_km FROM lagged""", _LAGGED)

DERIVED_SPEED_SQL = _with(f"""
SELECT ping_id, driver_id, event_time, round({HAV}, 6) AS distance_km,
       (t - pt) / 1e6 AS seconds_since_prev,
       CASE WHEN pt IS NULL THEN NULL
            WHEN (t - pt) / 1e6 > 0 THEN round({HAV} / ((t - pt) / 1e6) * 3600e0, 2)
            ELSE 0e0 END AS derived_speed_kmh
FROM lagged""", _LAGGED)

SEGMENTS_SQL = _with(f"""
SELECT driver_id, max(status) AS status,
       min(event_time) AS segment_start, max(event_time) AS segment_end,
       count(*) AS pings,
       coalesce(sum(CASE WHEN chg = 0 THEN CAST(round({HAV} * 1e6) AS BIGINT) END), 0) / 1e6 AS distance_km,
       (max(t) - min(t)) / 1e6 AS duration_secs
FROM (SELECT *, sum(chg) OVER (PARTITION BY driver_id ORDER BY event_time, ping_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seg
      FROM (SELECT *, CASE WHEN pt IS NULL OR status IS DISTINCT FROM pstatus THEN 1 ELSE 0 END AS chg
            FROM lagged))
GROUP BY driver_id, seg""", _LAGGED)

LIVE_SQL = _with("""
SELECT driver_id, latitude, longitude, h3_cell, status, speed_kmh,
       strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') AS ts_str, event_time
FROM enriched WHERE event_time IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY driver_id ORDER BY event_time DESC, ping_id DESC) = 1""")

ACTIVE_SQL = _with("""
SELECT driver_id, max(event_time) AS last_seen FROM pings
WHERE event_time > (SELECT max(event_time) FROM pings) - INTERVAL 300 SECOND
  AND event_time <= (SELECT max(event_time) FROM pings)
GROUP BY driver_id""")

_LAKE_PARTS = ("strftime(event_time, '%Y') AS year, strftime(event_time, '%m') AS month, "
               "strftime(event_time, '%d') AS day, strftime(event_time, '%H') AS hour")

ORACLE_SQL: dict[str, str] = {
    "ping_scan": _with(f"SELECT {PING_COLS} FROM pings"),
    "json_decode": _with(
        "SELECT ping_id, driver_id, latitude, longitude, status, speed_kmh, trip_duration_secs, "
        "CASE WHEN ping_id % 3 = 2 THEN date_trunc('millisecond', event_time) ELSE event_time END "
        "AS event_time, CASE WHEN ping_id % 3 = 2 THEN CAST(epoch_us(event_time) // 1000 AS VARCHAR) ELSE ts_str END AS ts_str, "
        "trip_distance_km FROM pings"),
    "json_quarantine": ("SELECT props AS raw, 'no_event_time' AS reason FROM events UNION ALL "
                        "SELECT translate(props, '{}', '()') AS raw, 'not_json' AS reason FROM events UNION ALL "
                        + " UNION ALL ".join(
                            f"SELECT '{{' || '{body}, \"ping_id\": ' || event_id || '}}' AS raw, '{reason}' AS reason FROM events"
                            for body, reason in UNUSABLE_MESSAGES)),
    "ping_limit": _with("SELECT least(count(*), 5) AS records FROM enriched"),
    "event_time_parse": _with(
        "SELECT ping_id, event_time AS from_ts_str, event_time AS from_iso, "
        "date_trunc('millisecond', event_time) AS from_millis FROM pings"),
    "ping_encode": _with(
        "SELECT driver_id AS key, to_json({'ping_id': ping_id, 'driver_id': driver_id, "
        "'latitude': round(latitude, 6), 'longitude': round(longitude, 6), 'status': status, "
        "'speed_kmh': round(speed_kmh, 2), "
        "'timestamp': strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f'), "
        "'trip_duration_secs': trip_duration_secs})::VARCHAR AS value FROM pings"),
    "enriched": _with(f"SELECT {ENRICHED_COLS} FROM enriched"),
    "hex_cell": _with("SELECT ping_id, latitude, longitude, h3_cell FROM enriched"),
    "anomaly_flags": _with("SELECT ping_id, speed_kmh, status, anomaly_type FROM enriched"),
    "trip_category": _with("SELECT ping_id, trip_duration_secs, trip_category FROM enriched"),
    "on_trip_pings": _with(f"SELECT {PING_COLS} FROM pings WHERE status = 'on_trip'"),
    "anomalies": _with(
        "SELECT event_time AS anomaly_time, driver_id, latitude, longitude, speed_kmh, status, "
        "anomaly_type, h3_cell FROM enriched WHERE anomaly_type <> 'NORMAL'"),
    "processing_stamps": _with(
        "SELECT 'ping' AS relation, count(*) AS records, count(*) AS stamped FROM enriched UNION ALL "
        "SELECT 'anomaly', count(*), count(*) FROM enriched WHERE anomaly_type <> 'NORMAL'"),
    "zone_counts": _with(
        "SELECT h3_cell, count(*) AS pings, count(DISTINCT driver_id) AS drivers "
        "FROM enriched GROUP BY h3_cell"),
    "sql_over_view": ZONE_SQL,
    "zone_occupancy": ZONE_SQL,
    "perf_metrics": PERF_SQL,
    "perf_metrics_sliding": SLIDING_SQL,
    "trip_sessions": SESSIONS_SQL,
    "haversine": HAVERSINE_SQL,
    "derived_speed": DERIVED_SPEED_SQL,
    "trip_segments": SEGMENTS_SQL,
    "live_state": LIVE_SQL,
    "cache_records": f"""SELECT 'driver:' || driver_id AS key, to_json({{'driver_id': driver_id, 'latitude': latitude,
        'longitude': longitude, 'h3_cell': coalesce(h3_cell, ''), 'status': status, 'speed_kmh': coalesce(speed_kmh, 0.0),
        'ts_str': ts_str}})::VARCHAR AS value, 60 AS ttl_secs FROM ({LIVE_SQL})""",
    "active_drivers": ACTIVE_SQL,
    "lake_partitions": _with(
        f"SELECT {_LAKE_PARTS}, count(*) AS records FROM enriched GROUP BY ALL"),
    "lake_roundtrip": _with(f"SELECT {ENRICHED_COLS}, {_LAKE_PARTS} FROM enriched"),
}


_ADAPTED_TIME = f"make_timestamp({ORIGIN_US} + (epoch_us(ts) - {ORIGIN_US}) // {TIME_COMPRESSION})"
FINAL_WM_MS = f"((SELECT max(epoch_ms({_ADAPTED_TIME})) FROM events) - 10000)"


STREAM_LIVE_SQL = f"""
SELECT driver_id, latitude, longitude, h3_cell, status, speed_kmh, ts_str, event_time,
       CASE WHEN epoch_ms(event_time) + 60000 <= {FINAL_WM_MS} THEN 'EXPIRED' ELSE 'LIVE' END AS state
FROM ({LIVE_SQL}) AS b"""


_SPAN = "span AS (SELECT min(epoch_us(event_time)) AS lo, max(epoch_us(event_time)) AS hi FROM pings)"


def _late_condition(order: list[int], chunks: int) -> str:
    """The chunks that arrive after a later one.  Chunk bounds are
    ``lo + i * ((hi - lo) // chunks)`` in microseconds, as the replay lands them."""
    late = [c for i, c in enumerate(order) if any(c < d for d in order[:i])]

    def bound(i: int) -> str | None:
        return f"(SELECT lo + {i} * ((hi - lo) // {chunks}) FROM span)" if 0 < i < chunks else None

    conds = []
    for c in late:
        lo_b, hi_b = bound(c), bound(c + 1)
        parts = [f"epoch_us(event_time) >= {lo_b}" if lo_b else "TRUE",
                 f"epoch_us(event_time) < {hi_b}" if hi_b else "TRUE"]
        conds.append("(" + " AND ".join(parts) + ")")
    return "(" + " OR ".join(conds or ["FALSE"]) + ")"


def late_data_sql(order: list[int], chunks: int) -> str:
    """Zone oracle without the late chunks (their windows are closed by then)."""
    return zone_sql("kept", f"{_SPAN}, kept AS (SELECT * FROM enriched WHERE NOT {_late_condition(order, chunks)})")


def late_rows_sql(order: list[int], chunks: int) -> str:
    return _with(f"SELECT {PING_COLS} FROM pings WHERE {_late_condition(order, chunks)}", _SPAN)


def delivery_sql(order: list[int], chunks: int) -> str:
    """Every event is a ping message and a foreign one without an event time."""
    counts = {"read": "2 * count(*)", "decoded": "count(*)", "quarantined": "count(*)", "written": "count(*)",
              "late": f"CAST(count_if({_late_condition(order, chunks)}) AS BIGINT)"}
    return _with(" UNION ALL ".join(f"SELECT '{k}' AS metric, {v} AS records FROM pings" for k, v in counts.items()), _SPAN)


BRANCH_COUNTS_SQL = _with("""
SELECT 'lake' AS branch, count(*) AS records FROM enriched
UNION ALL SELECT 'cache' AS branch, count(DISTINCT driver_id) AS records FROM enriched
UNION ALL SELECT 'anomalies' AS branch, count(*) AS records FROM enriched WHERE anomaly_type <> 'NORMAL'""")
