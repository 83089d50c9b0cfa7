"""Late pings kept as a side output (T5).

Spark drops rows that arrive behind the watermark without a trace but a count.  This
``foreachBatch`` body carries the running maximum of the event time from batch to batch
and writes the pings that lie behind it by more than the delay: those that no window
can count on.  Maximum and rows are written under the batch's own name, so a batch that
is run again replaces what it wrote.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import duration_micros
from ..schema import WATERMARK_DELAY


class LateRows:
    def __init__(self, base: str, delay: str = WATERMARK_DELAY):
        self.base, self.delay_us = base.rstrip("/"), duration_micros(delay)

    def _maximum(self, spark: SparkSession, batch_id: int) -> int | None:
        """The running maximum after a batch, in microseconds."""
        try:
            return spark.read.schema("maximum long").parquet(f"{self.base}/maximum/batch={batch_id:012d}").first()[0]
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":  # before the first batch
                raise
            return None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = self._maximum(spark, batch_id - 1) if batch_id else None
        t = F.unix_micros("event_time")
        late = batch.where(t < before - self.delay_us) if before is not None else batch.limit(0)
        late.write.mode("overwrite").parquet(f"{self.base}/rows/batch={batch_id:012d}")
        # null (no time seen yet) is ignored by greatest
        batch.agg(F.greatest(F.max(t), F.lit(before).cast("long")).alias("maximum")).write.mode("overwrite").parquet(
            f"{self.base}/maximum/batch={batch_id:012d}")

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.base}/rows").drop("batch")


def keep_late_rows(pings: DataFrame, base: str, checkpoint: str, delay: str = WATERMARK_DELAY):
    """Writer of the late pings of a stream under ``base``."""
    return pings.writeStream.foreachBatch(LateRows(base, delay)).option("checkpointLocation", checkpoint)
