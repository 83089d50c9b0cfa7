"""Console output (S7) and delivery reporting."""

from __future__ import annotations

from collections import Counter, deque

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def console(df: DataFrame, num_rows: int = 20, truncate: bool = False):
    """Console sink writer (the reference prints each result table)."""
    return (df.writeStream.format("console").option("numRows", num_rows)
            .option("truncate", str(truncate).lower()))


def counted(df: DataFrame, name: str = "output") -> DataFrame:
    """The rows that pass here, observed as ``written`` with each batch (sinks don't count them)."""
    return df.observe(name, F.count("*").alias("written"))


class DeliveryReport(StreamingQueryListener):
    """What was delivered, from the observed metrics of every query of a session.

    Totals are kept for each query and metric: ``read``, ``decoded`` and ``quarantined`` of the
    decoding query, ``written`` of outputs, ``input_rows`` and ``dropped_late`` of all.  Of the
    batches only the last ``keep`` are remembered, so the report does not grow with time.
    Register with ``spark.streams.addListener(DeliveryReport())``."""

    def __init__(self, keep: int = 100):
        self.batches: deque[dict] = deque(maxlen=keep)
        self.failures: deque[dict] = deque(maxlen=keep)
        self.totals: Counter[tuple[str, str]] = Counter()

    def record(self, progress) -> None:
        """Add a batch's progress report."""
        metrics = {"input_rows": progress.numInputRows,
                   "dropped_late": sum(int(op.numRowsDroppedByWatermark or 0) for op in progress.stateOperators or [])}
        for row in (progress.observedMetrics or {}).values():
            metrics.update({k: int(v or 0) for k, v in row.asDict().items()})
        name = progress.name or str(progress.id)
        self.batches.append({"query": name, "batch": progress.batchId, **metrics})
        for k, v in metrics.items():
            self.totals[name, k] += v

    def total(self, metric: str, query: str | None = None) -> int:
        return sum(v for (q, k), v in self.totals.items() if k == metric and query in (None, q))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.record(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.failures.append({"query": str(event.id), "error": event.exception})
