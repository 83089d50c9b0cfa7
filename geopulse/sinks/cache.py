"""Versioned upserts of the live cache.

A cache record is a key, a JSON value and a time to live; its version is
``(event_time, ping_id)`` of the ping it shows.  A write is conditional: it takes effect
only if its version is not older than the stored one, so batches that arrive out of
order, again or twice leave the same cache.  Two stores implement it:

* :class:`ExternalUpserts` sends a batch's records to any key-value store, one client
  for each partition; the client's ``put_if_newer`` is the store's own conditional write.
* :class:`KeyedTable` is a plain table of records, one folder for each shard of keys.  A
  batch rewrites the shards it touches, staged under its own name first, so a batch that
  failed half-way is simply run again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..operators.live import cache_records

RECORD_COLUMNS = ["key", "value", "ttl_secs", "event_time", "ping_id"]


class CacheClient(Protocol):
    """What a store's client has to offer."""

    def put_if_newer(self, key: str, value: str, ttl_secs: int, version: tuple[int, int], batch_id: int) -> None:
        """Store the record unless the stored version is newer; ``version`` is (epoch microseconds, ping id)."""

    def close(self) -> None: ...


class ExternalUpserts:
    """Writes records through clients that ``connect`` opens on the executors."""

    def __init__(self, connect: Callable[[], CacheClient]):
        self.connect = connect

    def upsert(self, records: DataFrame, batch_id: int) -> None:
        connect = self.connect

        def write(rows: Iterator[Row]) -> None:
            client = None
            try:
                for r in rows:
                    client = client or connect()  # none for an empty partition
                    client.put_if_newer(r.key, r.value, r.ttl_secs, (r.micros, r.ping_id), batch_id)
            finally:
                if client is not None:
                    client.close()

        records.select("key", "value", "ttl_secs", F.unix_micros(F.col("event_time").cast("timestamp")).alias("micros"),
                       "ping_id").foreachPartition(write)


class KeyedTable:
    """Records by key in a folder of shards, the newest version of each."""

    def __init__(self, path: str, shards: int = 16):
        self.path, self.shards = path.rstrip("/"), shards

    def _rows(self, spark: SparkSession) -> DataFrame | None:
        try:
            return spark.read.parquet(f"{self.path}/table")
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # nothing written yet; else a failure
                raise
            return None

    def upsert(self, records: DataFrame, batch_id: int) -> None:
        spark = records.sparkSession
        fresh = records.select(*RECORD_COLUMNS, F.pmod(F.xxhash64("key"), F.lit(self.shards)).cast("int").alias("shard"))
        touched = [r.shard for r in fresh.select("shard").distinct().collect()]  # as many as shards at most
        if not touched:
            return
        stored = self._rows(spark)
        if stored is not None:
            fresh = stored.where(F.col("shard").isin(touched)).select(*fresh.columns).unionByName(fresh)
        staged = f"{self.path}/staged/batch={batch_id:012d}"
        newest(fresh, "shard").write.mode("overwrite").parquet(staged)
        (spark.read.parquet(staged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("shard").parquet(f"{self.path}/table"))

    def read(self, spark: SparkSession, as_of: Column | None = None) -> DataFrame:
        """The records; with ``as_of`` only those that have not expired by then."""
        rows = self._rows(spark)
        if rows is None:
            rows = spark.createDataFrame([], "key string, value string, ttl_secs int, event_time timestamp, ping_id long")
        if as_of is not None:
            rows = rows.where(F.timestamp_add("SECOND", F.col("ttl_secs"), F.col("event_time")) > as_of)
        return rows.select(*RECORD_COLUMNS)


def newest(records: DataFrame, *also_by: str) -> DataFrame:
    """The newest version of each key (``value`` decides between equal versions)."""
    version = F.struct("event_time", "ping_id", "value")
    return (records.groupBy("key", *also_by).agg(F.max_by(F.struct("value", "ttl_secs", "event_time", "ping_id"), version).alias("r"))
            .select("key", "r.*", *also_by))


def versioned_records(enriched: DataFrame) -> DataFrame:
    """A batch's cache records with their versions, one for each driver."""
    return cache_records(enriched, versioned=True)
