"""Enriching projection (P1), filters (P2, P3) and the anomaly side output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import anomaly_type, trip_category, with_hex_cell
from ..schema import ANOMALY_NORMAL, HEX_RESOLUTION, PING_COLUMNS

ENRICHED_COLUMNS = PING_COLUMNS + ["h3_cell", "anomaly_type", "trip_category"]

ANOMALY_COLUMNS = ["anomaly_time", "driver_id", "latitude", "longitude", "speed_kmh",
                   "status", "anomaly_type", "h3_cell"]


def enrich(pings: DataFrame, resolution: int = HEX_RESOLUTION,
           processing_time: bool = False) -> DataFrame:
    """Add zone, anomaly flag and trip category; optionally a processing stamp.

    ``processing_time`` is ``current_timestamp()``, constant within a query (or
    a micro-batch), so it is left out of anything compared across engines.
    """
    out = with_hex_cell(pings, "latitude", "longitude", resolution).withColumns({
        "anomaly_type": anomaly_type("speed_kmh", "status"),
        "trip_category": trip_category("trip_duration_secs"),
    })
    if processing_time:
        out = out.withColumn("processing_time", F.current_timestamp())
    return out


def anomalies(enriched: DataFrame, detected_at: bool = False) -> DataFrame:
    """Side output of pings whose anomaly type is not ``NORMAL`` (NULL dropped)."""
    out = (enriched.filter(F.col("anomaly_type") != ANOMALY_NORMAL)
           .select(F.col("event_time").alias("anomaly_time"), *ANOMALY_COLUMNS[1:]))
    if detected_at:
        out = out.withColumn("detected_at", F.current_timestamp())
    return out


def zone_counts(enriched: DataFrame) -> DataFrame:
    """Pings and distinct drivers per zone over the whole input.

    Written as two aggregations (zone, driver) then zone, so a hot zone is
    pre-aggregated per driver on the map side before its single reducer.
    """
    per_driver = enriched.groupBy("h3_cell", "driver_id").agg(F.count(F.lit(1)).alias("n"))
    return per_driver.groupBy("h3_cell").agg(
        F.sum("n").alias("pings"), F.count("driver_id").alias("drivers"))
