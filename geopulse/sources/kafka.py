"""Kafka topic as ping source and as keyed sink.

Needs the ``spark-sql-kafka`` connector on the classpath (not bundled with
PySpark); everything here is plain ``readStream`` / ``writeStream`` options.
Offsets live in the query checkpoint, so the consumer group of the
reference is not needed for exactly-once replay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import WATERMARK_DELAY
from . import wire


def source_options(bootstrap: str, topic: str, starting_offsets: str = "latest",
                   max_offsets_per_trigger: int | None = None, group_id: str | None = None,
                   extra: dict | None = None) -> dict:
    """Options for ``readStream.format("kafka")``.

    ``starting_offsets``: ``latest`` as the reference (``scan.startup.mode =
    latest-offset``), ``earliest`` for a replay.  ``max_offsets_per_trigger``
    bounds a micro-batch (the reference flushes every 100 records).
    Lost offsets fail the query (Spark's default); skipping them must be asked for in ``extra``.
    """
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
            "startingOffsets": starting_offsets}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if group_id:
        opts["kafka.group.id"] = group_id
    opts.update(extra or {})
    return opts


def read_messages(spark: SparkSession, bootstrap: str, topic: str, **kw) -> DataFrame:
    """Streaming raw messages (``value``, ``_offset_id``) of a topic.

    Without a ping_id in the payload, (partition, offset) orders a driver's
    pings as they arrived (the producer keys every driver to one partition)."""
    raw = spark.readStream.format("kafka").options(**source_options(bootstrap, topic, **kw)).load()
    offset_id = F.shiftleft(F.col("partition").cast("bigint"), 40) + F.col("offset")
    return raw.select(F.col("value").cast("string").alias("value"), offset_id.alias("_offset_id"))


def read_pings(spark: SparkSession, bootstrap: str, topic: str, watermark: str = WATERMARK_DELAY,
               **kw) -> tuple[DataFrame, DataFrame]:
    """Streaming (pings, quarantine) decoded from a Kafka topic.

    The pings carry the event-time watermark; the quarantine stream holds
    undecodable messages with a reason and can be written to its own sink.
    """
    good, bad = wire.decode_with_quarantine(read_messages(spark, bootstrap, topic, **kw), fallback_id="_offset_id")
    return good.withWatermark("event_time", watermark), bad


def sink_options(bootstrap: str, topic: str, extra: dict | None = None) -> dict:
    return {"kafka.bootstrap.servers": bootstrap, "topic": topic, **(extra or {})}


def write_pings(pings: DataFrame, bootstrap: str, topic: str, checkpoint: str,
                time_encoding: str = "iso"):
    """Keyed JSON messages (key = driver id) to a topic; returns the writer.

    Keying by driver keeps each driver's pings in one topic partition, in
    order, as the producer does."""
    return (wire.encode(pings, time_encoding).writeStream.format("kafka")
            .options(**sink_options(bootstrap, topic))
            .option("checkpointLocation", checkpoint))
