"""File sources: JSON-lines wire messages and canonical ping tables (S1 for
replay, T8).  The same decode path as the Kafka source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schema import PING_SCHEMA, WATERMARK_DELAY
from . import wire


def read_message_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of raw messages (``value``) from a folder of JSON lines."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def read_wire_stream(spark: SparkSession, path: str, watermark: str = WATERMARK_DELAY,
                     max_files_per_trigger: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Stream (pings, quarantine) from a folder of JSON-lines messages."""
    good, bad = wire.decode_with_quarantine(read_message_stream(spark, path, max_files_per_trigger))
    return good.withWatermark("event_time", watermark), bad


def read_wire_batch(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Batch (pings, quarantine) from the same folder layout."""
    return wire.decode_with_quarantine(spark.read.format("text").load(path))


def read_ping_stream(spark: SparkSession, path: str, watermark: str = WATERMARK_DELAY) -> DataFrame:
    """Stream of canonical pings stored as parquet."""
    return spark.readStream.schema(PING_SCHEMA).parquet(path).withWatermark("event_time", watermark)
