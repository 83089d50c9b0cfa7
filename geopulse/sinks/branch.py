"""Stream branching (S14): one enriched stream feeding the lake, the live
cache and the anomaly output.

* Lake: its own query on Spark's JSON file sink (exactly-once through the
  sink's metadata log).
* Cache and anomalies: one ``foreachBatch`` query; the micro-batch is
  persisted once and written to both.  Anomalies are keyed by the batch id and
  overwritten; the cache gets versioned records (see ``sinks.cache``).  So a batch that
  is run again changes nothing, and an older one never wins over a newer one.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ..operators.enrich import anomalies
from . import lake
from .cache import KeyedTable, versioned_records


class CacheAndAnomalies:
    """``foreachBatch`` body writing the anomaly slice and the cache records.

    ``store`` has ``upsert(records, batch_id)``; the default is a table under ``base``."""

    def __init__(self, base: str, store=None):
        self.base = base.rstrip("/")
        self.store = store or KeyedTable(f"{self.base}/cache")

    def anomaly_path(self, batch_id: int) -> str:
        return f"{self.base}/anomalies/batch={batch_id:012d}"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            anomalies(batch).write.mode("overwrite").parquet(self.anomaly_path(batch_id))
            self.store.upsert(versioned_records(batch), batch_id)
        finally:
            batch.unpersist()

    def all_anomalies(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.base}/anomalies").drop("batch")


def start_branches(enriched_stream: DataFrame, base: str, trigger: dict, store=None,
                   records_per_object: int | None = None):
    """Start the lake query and the cache+anomaly query; returns both
    queries and the ``CacheAndAnomalies`` writer (for reading back)."""
    base = base.rstrip("/")
    lake_q = (lake.stream_to_lake(enriched_stream, f"{base}/lake", f"{base}/_ck_lake",
                                  records_per_object)
              .queryName("geopulse_lake").trigger(**trigger).start())
    writer = CacheAndAnomalies(base, store)
    side_q = (enriched_stream.writeStream.foreachBatch(writer).queryName("geopulse_cache")
              .option("checkpointLocation", f"{base}/_ck_side")
              .trigger(**trigger).start())
    return [lake_q, side_q], writer
