"""The decoded log: every raw message is read and decoded once.

One query decodes the messages and writes good pings and quarantined messages to one
log, partitioned by kind.  Spark's file sink makes it durable: its metadata log
lists committed files only, and streams that read the log follow it.  All outputs run
from the log, however many there are, so the source is not read again for each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import PING_COLUMNS, PING_SCHEMA, WATERMARK_DELAY
from . import wire

KIND_PING, KIND_QUARANTINE = "ping", "quarantine"
#: Name of the counts that the decoding query reports with each batch.
DELIVERY = "delivery"

LOG_SCHEMA = T.StructType([*PING_SCHEMA.fields, T.StructField("raw", T.StringType()), T.StructField("reason", T.StringType()),
                           T.StructField("kind", T.StringType())])


def decode_to_log(messages: DataFrame, path: str, checkpoint: str, fallback_id: str | None = None):
    """Writer of the log of a stream of messages (``value``); counts are observed as they pass."""
    rows = wire.decode_all(messages, fallback_id=fallback_id)
    kind = F.when(F.col("reason").isNull(), KIND_PING).otherwise(KIND_QUARANTINE)
    return (rows.withColumn("kind", kind)
            .observe(DELIVERY, F.count("*").alias("read"), F.count_if(F.col("reason").isNull()).alias("decoded"),
                     F.count_if(F.col("reason").isNotNull()).alias("quarantined"))
            .writeStream.format("parquet").queryName("geopulse_decode").outputMode("append")
            .partitionBy("kind").option("path", path).option("checkpointLocation", checkpoint))


def prepare_log(spark: SparkSession, path: str) -> None:
    """An empty folder, so that outputs can start before the first message is decoded."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)


def read_log(spark: SparkSession, path: str, watermark: str = WATERMARK_DELAY) -> tuple[DataFrame, DataFrame]:
    """Streams (pings with their watermark, quarantine) of a log."""
    rows = spark.readStream.schema(LOG_SCHEMA).parquet(path)
    pings = rows.where(F.col("kind") == KIND_PING).select(*PING_COLUMNS)
    return pings.withWatermark("event_time", watermark), rows.where(F.col("kind") == KIND_QUARANTINE).select("raw", "reason")
