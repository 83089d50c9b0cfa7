"""Several ping sources in one stream, each with a watermark of its own.

A fleet can report through several topics or landing folders that run behind each other.
Each source declares its own watermark; Spark combines them by
``spark.sql.streaming.multipleWatermarkPolicy``:

* ``min`` (default): the slowest source holds the watermark back, nothing that is on
  time in its own source is late;
* ``max``: the fastest one drives it, what slower sources send behind it is dropped.

A source that falls silent holds ``min`` back until it speaks again.  ``max`` is then the
counterpart of an idle timeout, at the price of the silent source's late pings.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

POLICY = "spark.sql.streaming.multipleWatermarkPolicy"


def union_sources(sources: list[DataFrame]) -> DataFrame:
    """One stream of watermarked ping streams.  The policy is a setting of the session that starts the
    query, and the query keeps it in its checkpoint for life."""
    if not sources:
        raise ValueError("no source")
    return reduce(DataFrame.unionByName, sources)
