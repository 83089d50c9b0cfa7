"""Replay a ping table through a streaming query (Kappa replay, T8).

The table is staged once, split into time chunks, under the shared
checkpoint folder; the chunks are then landed one at a time, and after each
the query runs with
``trigger(availableNow=True)`` and resumes from its checkpoint, the way a live
source delivers data over time (and a restart from the checkpoint is
exercised on every chunk).  The sink is Spark's file sink, whose metadata log
makes each micro-batch visible exactly once.

A bounded replay can be flushed: after the last chunk an end marker, later than
every ping, moves the watermark past all windows, sessions and pending pings.
Results never hold a marker.

Streams run in a session of their own, so the partition count and the state store they
need don't change what other queries run under.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import WATERMARK_DELAY
from ..operators.windows import duration_micros
from ..session import default_parallelism, ensure_utc, isolated_session, scratch_dir
from ..sources import files, wire
from ..sources.events import to_stream_time
from ..sources.union import POLICY, union_sources


@dataclass
class ReplayRun:
    base: str
    landing: str
    output: str
    checkpoint: str
    progress: list


def stream_source(spark: SparkSession, landing: str, schema: T.StructType,
                  watermark: str | None = WATERMARK_DELAY, max_files_per_trigger: int | None = None) -> DataFrame:
    """File-stream source of pings with the event-time watermark declared."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.parquet(landing)
    return df.withWatermark("event_time", watermark) if watermark else df


def time_span(pings: DataFrame) -> tuple[int, int] | None:
    """First and last event time in integer microseconds (one tiny aggregate); None without any."""
    us = F.unix_micros(F.col("event_time"))
    lo, hi = pings.agg(F.min(us), F.max(us)).first()
    return None if lo is None else (lo, hi)


def chunk_bounds(span: tuple[int, int] | None, chunks: int) -> list[int]:
    """Inner chunk bounds ``lo + i * ((hi - lo) div chunks)`` (exact, so an oracle can recompute them)."""
    if span is None:
        return []
    lo, hi = span
    return [lo + (hi - lo) // chunks * i for i in range(1, chunks)]


def time_chunks(pings: DataFrame, chunks: int) -> list[int]:
    return chunk_bounds(time_span(pings), chunks)


#: End markers of a flushed replay: one per driver this long after the last ping, then the one that moves
#: the watermark.  Both are far beyond the longest window, gap and watermark delay.
DRIVER_END_US = 3_600_000_000
REPLAY_END_US = 86_400_000_000
END_STATUS = "<end>"


def land_end_markers(spark: SparkSession, src: DataFrame, landing: str, last_us: int, per_driver: bool,
                     as_text: bool = False, offset_us: int = REPLAY_END_US) -> None:
    """The markers, as pings without values (as messages: with those that decoding asks for); those of
    drivers have a status of their own."""
    fixed = {"latitude": F.lit(0.0), "longitude": F.lit(0.0)} if as_text else {}

    def markers(rows: DataFrame, driver, offset: int) -> DataFrame:
        values = {**fixed, "driver_id": driver, "status": F.lit(END_STATUS), "ping_id": F.lit(-1),
                  "event_time": F.timestamp_micros(F.lit(last_us + offset))}
        return rows.select(*(values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in src.schema.fields))

    out = markers(spark.range(1), F.lit(END_STATUS) if as_text else F.lit(None), offset_us)
    if per_driver:
        out = out.unionByName(markers(src.select("driver_id").distinct(), F.col("driver_id"), DRIVER_END_US))
    if as_text:
        wire.encode(out).select("value").write.mode("append").text(landing)
    else:
        out.write.mode("append").parquet(landing)


def without_markers(stream: DataFrame, last_us: int) -> DataFrame:
    """Rows up to ``last_us``.

    Conditions on the watermarked column stay above the watermark.  The other columns
    are made to depend on it, so that a filter of theirs cannot move below the
    watermark either and take a marker away before it is seen.
    """
    t = F.col("event_time")
    ping = t.isNull() | (t <= F.timestamp_micros(F.lit(last_us)))
    return stream.withColumns({c: F.when(ping, F.col(c)) for c in stream.columns if c != "event_time"}).filter(ping)


def chunk_id(bounds: list[int], swap_us: int = 0) -> F.Column:
    """Index of the time chunk a row falls in: the number of inner bounds at
    or below its event time (microseconds).  With ``swap_us`` the bands
    ``[b - swap, b)`` and ``[b, b + swap)`` around every bound trade chunks,
    so later pings arrive before earlier ones (out-of-order delivery)."""
    us = F.unix_micros(F.col("event_time"))
    out = F.lit(0)
    for b in bounds:
        out = out + F.when(us >= F.lit(b), 1).otherwise(0)
        if swap_us:
            out = (out + F.when((us >= F.lit(b - swap_us)) & (us < F.lit(b)), 1).otherwise(0)
                   - F.when((us >= F.lit(b)) & (us < F.lit(b + swap_us)), 1).otherwise(0))
    return out


def stage_chunks(pings: DataFrame, staging: str, bounds: list[int], as_text: bool = False,
                 swap_us: int = 0) -> T.StructType:
    """One pass over the input (returns the staged schema): rows written under ``_chunk=i`` folders, so
    landing a chunk later reads only its own folder (partition pruning)."""
    staged = pings.withColumn("_chunk", chunk_id(bounds, swap_us))
    if as_text:
        staged = staged.select("value", "_chunk")
    staged.write.mode("overwrite").partitionBy("_chunk").parquet(staging)
    return staged.schema


def land_chunk(spark: SparkSession, staging: str, landing: str, i: int, schema: T.StructType,
               as_text: bool = False) -> None:
    """The schema makes an empty staging folder an empty chunk; a missing or unreadable one raises."""
    chunk = spark.read.schema(schema).parquet(staging).filter(F.col("_chunk") == i).drop("_chunk")
    if as_text:
        chunk.select("value").write.mode("append").text(landing)
    else:
        chunk.write.mode("append").parquet(landing)


def _stream_session(spark: SparkSession, state_partitions: int | None, **settings: str) -> SparkSession:
    """Where a replay's queries run; stateful operators keep its partition count for life."""
    return isolated_session(spark, {"spark.sql.shuffle.partitions": str(state_partitions or default_parallelism(spark)), **settings})


def _run_once(run: ReplayRun, result: DataFrame, writer) -> None:
    """Start the query or queries of a step, wait for their end and keep their progress."""
    if writer is not None:
        w = writer(result, run)
    else:
        w = (result.writeStream.format("parquet").outputMode("append")
             .option("path", run.output).option("checkpointLocation", run.checkpoint))
    started = w.trigger(availableNow=True).start() if hasattr(w, "trigger") else w
    for q in (started if isinstance(started, list) else [started]):
        q.awaitTermination()
        run.progress.extend(q.recentProgress)


def run_replay(spark: SparkSession, pings: DataFrame,
               build: Callable[[DataFrame], DataFrame] | None = None,
               label: str = "replay", chunks: int = 4,
               order: list[int] | None = None,
               writer: Callable[[DataFrame, ReplayRun], object] | None = None,
               watermark: str | None = WATERMARK_DELAY,
               state_partitions: int | None = None, wire_format: bool = False,
               swap_us: int = 0, flush: str | None = None, raw: bool = False,
               more_messages: DataFrame | None = None) -> ReplayRun:
    """Land ``pings`` chunk by chunk and run the streaming query after each.

    ``build`` maps the watermarked source stream to the result stream (parquet
    file sink, append mode).  ``writer`` replaces the sink entirely: it gets
    the result stream and the run's folders and returns a started query, a list of
    them or a ``DataStreamWriter``.  ``order`` permutes chunk delivery (late data tests).
    With ``wire_format`` the chunks are landed as JSON-lines messages (time
    encodings rotating by ping id) and read back through the streaming
    decoder, so ``build`` sees decoded pings; the quarantine is not written.
    ``raw`` hands the messages themselves to ``build`` or ``writer``; ``more_messages``
    (``value``) are landed with the first chunk.
    ``swap_us`` delivers the pings around each chunk edge out of order (see
    ``chunk_id``); keep it under half the watermark delay so nothing is late.
    ``state_partitions`` (default: the context's parallelism) is the shuffle
    partition count the stateful operators are created with.
    ``flush="time"`` closes whatever the last watermark leaves open;
    ``flush="drivers"`` also shows ``build`` one last ping of status
    ``END_STATUS`` for each driver, for operators that wait for a next ping;
    ``flush="last"`` moves the watermark to the last ping and no further.
    """
    ensure_utc(spark)
    base = scratch_dir(spark, label)
    run = ReplayRun(base, base + "/landing", base + "/out", base + "/checkpoint", [])
    src = to_stream_time(pings)
    span = time_span(src)
    bounds = chunk_bounds(span, chunks)
    flush = flush if span else None
    as_text = wire_format or raw
    staged_rows = wire.encode_mixed(src).select("value", "event_time") if as_text else src
    if more_messages is not None:
        staged_rows = staged_rows.unionByName(more_messages.select("value", F.lit(None).cast("timestamp").alias("event_time")))
    staged = stage_chunks(staged_rows, base + "/staging", bounds, as_text=as_text, swap_us=swap_us)
    session = _stream_session(spark, state_partitions)
    steps = [*(order if order is not None else range(len(bounds) + 1)), *([None] if flush else [])]
    for i in steps:
        if i is None:
            offset = duration_micros(watermark or WATERMARK_DELAY) if flush == "last" else REPLAY_END_US
            land_end_markers(spark, src, run.landing, span[1], flush == "drivers", as_text, offset)
        else:
            land_chunk(spark, base + "/staging", run.landing, i, staged, as_text=as_text)
        if raw:
            stream = files.read_message_stream(session, run.landing)
        elif wire_format:
            stream = files.read_wire_stream(session, run.landing, watermark or WATERMARK_DELAY)[0]
        else:
            stream = stream_source(session, run.landing, src.schema, watermark)
        if flush and not raw:
            stream = without_markers(stream, span[1] + (DRIVER_END_US if flush == "drivers" else 0))
        _run_once(run, build(stream) if build else stream, writer)
    return run


def run_union_replay(spark: SparkSession, sources: list[DataFrame], build: Callable[[DataFrame], DataFrame],
                     label: str, lags_us: list[int], policy: str = "min", chunks: int = 4,
                     state_partitions: int | None = None, flush: bool = True) -> ReplayRun:
    """Land several ping tables, each in a folder of its own and running ``lags_us`` behind the
    first, and run one query over their union after each step.

    At step i a source has delivered its pings up to the i-th bound less its lag.  Each source
    declares its own watermark; ``policy`` combines them.
    """
    ensure_utc(spark)
    base = scratch_dir(spark, label)
    run = ReplayRun(base, base + "/landing", base + "/out", base + "/checkpoint", [])
    tables = [to_stream_time(s) for s in sources]
    span = time_span(union_sources(tables))
    bounds = chunk_bounds(span, chunks)
    staged = [stage_chunks(t, f"{base}/staging-{k}", [b - lag for b in bounds])
              for k, (t, lag) in enumerate(zip(tables, lags_us, strict=True))]
    session = _stream_session(spark, state_partitions, **{POLICY: policy})
    for i in [*range(len(bounds) + 1), *([None] if flush and span else [])]:
        streams = []
        for k, t in enumerate(tables):
            landing = f"{run.landing}-{k}"
            if i is None:
                land_end_markers(spark, t, landing, span[1], False)
            else:
                land_chunk(spark, f"{base}/staging-{k}", landing, i, staged[k])
            streams.append(stream_source(session, landing, t.schema))
        stream = union_sources(streams)
        if flush and span:
            stream = without_markers(stream, span[1])
        _run_once(run, build(stream), None)
    return run


def read_output(spark: SparkSession, run: ReplayRun, schema: T.StructType | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(run.output)


def to_ntz(df: DataFrame) -> DataFrame:
    """Cast every TIMESTAMP column to TIMESTAMP_NTZ (UTC wall clock)."""
    casts = {f.name: F.col(f.name).cast("timestamp_ntz")
             for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)}
    return df.withColumns(casts) if casts else df


def dropped_by_watermark(run: ReplayRun, operator: int | None = None) -> int:
    """Rows dropped as late, summed over batches and stateful operators (or
    one operator by its index in the progress report).  Aggregations count
    rows after map-side partial aggregation, not raw input rows."""
    import json
    total = 0
    for p in run.progress:
        d = p if isinstance(p, dict) else json.loads(p.json)
        ops = d.get("stateOperators", []) or []
        for i, op in enumerate(ops):
            if operator is None or i == operator:
                total += int(op.get("numRowsDroppedByWatermark", 0) or 0)
    return total
