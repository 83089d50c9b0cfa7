"""Date-partitioned JSON-lines lake.

Partitions are ``year=YYYY/month=MM/day=DD/hour=HH`` of the **event** time,
so a replay lands rows where a live run would have.  Writes go through
Spark's committer (batch) or the file sink with its metadata log (stream),
so a retried task or micro-batch is never visible twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTITION_COLUMNS = ["year", "month", "day", "hour"]

# Timestamps keep microseconds in the JSON text (the default writes millis).
TIME_FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def with_partitions(df: DataFrame, time_col: str = "event_time") -> DataFrame:
    t = F.col(time_col)
    return df.withColumns({
        "year": F.date_format(t, "yyyy"),
        "month": F.date_format(t, "MM"),
        "day": F.date_format(t, "dd"),
        "hour": F.date_format(t, "HH"),
    })


def write_lake(df: DataFrame, path: str, records_per_object: int | None = None,
               mode: str = "append") -> None:
    """Write rows as JSON lines under event-time partitions.

    The rows are rebalanced by the partition columns: an hour's rows come together, so an
    hour has as many files as its size needs, not one of every task; a busy hour is split
    by its size and small ones share a task (adaptive execution's
    ``advisoryPartitionSizeInBytes``).  ``records_per_object`` (the reference batches
    100) bounds the records of a file.
    """
    w = with_partitions(df).hint("rebalance", *PARTITION_COLUMNS).write.mode(mode).partitionBy(*PARTITION_COLUMNS).options(**TIME_FORMATS)
    if records_per_object:
        w = w.option("maxRecordsPerFile", records_per_object)
    w.json(path)


def lake_schema(row_schema: T.StructType) -> T.StructType:
    """Reader schema: the row fields plus string partition columns (so that
    ``month=01`` stays ``'01'`` rather than being inferred as 1)."""
    return T.StructType(list(row_schema.fields)
                        + [T.StructField(c, T.StringType()) for c in PARTITION_COLUMNS])


def read_lake(spark: SparkSession, path: str, row_schema: T.StructType) -> DataFrame:
    return spark.read.schema(lake_schema(row_schema)).options(**TIME_FORMATS).json(path)


def partition_counts(lake: DataFrame) -> DataFrame:
    """Records per lake partition; the partition columns are pruned from the
    path, so only file listing and a count are needed."""
    return lake.groupBy(*PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("records"))


def stream_to_lake(stream: DataFrame, path: str, checkpoint: str,
                   records_per_object: int | None = None):
    """Streaming writer for the lake (returns a ``DataStreamWriter``)."""
    w = (with_partitions(stream).writeStream.format("json")
         .partitionBy(*PARTITION_COLUMNS).options(**TIME_FORMATS)
         .option("path", path).option("checkpointLocation", checkpoint)
         .outputMode("append"))
    if records_per_object:
        w = w.option("maxRecordsPerFile", records_per_object)
    return w
