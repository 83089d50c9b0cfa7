"""SQL surface: temporary views and SQL functions.

The reference registers its three row functions for SQL and queries a
temporary view.  Here the functions are SQL functions whose bodies are
built-in expressions, so Catalyst inlines them and no Python worker runs.
They work over batch and streaming views alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schema import HEX_RESOLUTION
from .sqltext import (
    anomaly_sql, exact_mean_sql, exact_speed_sql, finite_speed_sql, exact_percent_sql, hex_lateral, hex_sql, trip_category_sql,
)


def register_functions(spark: SparkSession) -> None:
    """``hex_index(lat, lon[, resolution])``, ``detect_anomaly(speed, status)``,
    ``trip_duration_category(secs)`` as temporary SQL functions."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION hex_index(lat DOUBLE, lon DOUBLE, "
        f"resolution INT DEFAULT {HEX_RESOLUTION}) RETURNS STRING "
        f"RETURN {hex_sql('lat', 'lon', 'resolution')}")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION detect_anomaly(speed_kmh DOUBLE, status STRING) "
        f"RETURNS STRING RETURN {anomaly_sql('speed_kmh', 'status')}")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION trip_duration_category(duration_secs INT) "
        f"RETURNS BIGINT RETURN {trip_category_sql('duration_secs')}")


def enriched_view_sql(source_view: str) -> str:
    """The enriched relation over a view; the zone is written as LATERAL stages, which Spark keeps
    as projections (inside ``hex_index`` it would repeat the intermediates)."""
    return f"""
        SELECT ping_id, driver_id, latitude, longitude, status, speed_kmh,
               trip_duration_secs, event_time,
               hex_cell AS h3_cell,
               detect_anomaly(speed_kmh, status) AS anomaly_type,
               trip_duration_category(trip_duration_secs) AS trip_category
        FROM {source_view}, {hex_lateral('latitude', 'longitude', HEX_RESOLUTION)}"""


def zone_occupancy_sql(view: str, size: str = "30 seconds") -> str:
    """W1 as SQL over a view.  The distinct count is written as two levels so
    the same text is valid on a streaming view."""
    mean = exact_mean_sql("sum(s)", "sum(ns)")
    pct = exact_percent_sql("sum(trips)", "sum(n)")
    return f"""
        SELECT w.start AS window_start, w.end AS window_end, h3_cell, status,
               sum(n) AS ping_count, count(driver_id) AS unique_drivers,
               {mean} AS avg_speed,
               round(max(mx), 2) AS max_speed, round(min(mn), 2) AS min_speed,
               sum(trips) AS on_trip_count,
               {pct} AS on_trip_percentage
        FROM (
            SELECT window(event_time, '{size}') AS w, h3_cell, status, driver_id,
                   count(*) AS n, sum({exact_speed_sql('speed_kmh')}) AS s,
                   count({exact_speed_sql('speed_kmh')}) AS ns,
                   max({finite_speed_sql('speed_kmh')}) AS mx, min({finite_speed_sql('speed_kmh')}) AS mn,
                   count_if(status = 'on_trip') AS trips
            FROM {view}
            GROUP BY window(event_time, '{size}'), h3_cell, status, driver_id
        )
        GROUP BY w, h3_cell, status"""


def sql_zone_occupancy(spark: SparkSession, pings: DataFrame,
                       pings_view: str = "gps_pings", enriched_view: str = "enriched_gps") -> DataFrame:
    """Register functions and views, then run W1 as a SQL string."""
    register_functions(spark)
    pings.createOrReplaceTempView(pings_view)
    spark.sql(enriched_view_sql(pings_view)).createOrReplaceTempView(enriched_view)
    return spark.sql(zone_occupancy_sql(enriched_view))

