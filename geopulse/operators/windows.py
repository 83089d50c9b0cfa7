"""Windowed aggregations: zone occupancy (W1), fleet metrics (W3), sliding
metrics (W6) and trip sessions (W4).

All distinct counts are written as two chained aggregations (first by the
distinct value, then without it).  That form is exact, runs unchanged on a
stream in append mode (Spark refuses ``count_distinct`` there), and keeps a
hot group from landing on one reducer: the first level groups by the distinct
value as well, with map-side partial aggregation before each shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import exact_mean_2dp, exact_percent_2dp, exact_speed, finite_speed
from ..schema import (
    ANOMALY_NORMAL, METRIC_SLIDE, METRIC_WINDOW, SESSION_GAP, STATUS_ON_TRIP, ZONE_WINDOW,
)

ZONE_COLUMNS = ["window_start", "window_end", "h3_cell", "status", "ping_count",
                "unique_drivers", "avg_speed", "max_speed", "min_speed",
                "on_trip_count", "on_trip_percentage"]

METRIC_COLUMNS = ["total_events", "active_drivers", "active_zones", "trips_count",
                  "anomalies_count", "anomaly_rate_percent"]

SESSION_COLUMNS = ["driver_id", "trip_start", "trip_end", "total_pings",
                   "avg_speed_during_trip", "max_latitude", "max_longitude",
                   "min_latitude", "min_longitude", "h3_cells_visited", "max_trip_duration"]


def duration_micros(duration: str) -> int:
    """'30 seconds' / '1 minute' / '5 minutes' / '10 s' → microseconds."""
    n, unit = duration.split()
    unit = unit.lower().rstrip("s") or "s"
    scale = {"microsecond": 1, "millisecond": 1000, "second": 10**6, "s": 10**6,
             "sec": 10**6, "minute": 60 * 10**6, "min": 60 * 10**6, "hour": 3600 * 10**6,
             "day": 86400 * 10**6}[unit]
    return int(float(n) * scale)


def time_micros(df: DataFrame, col: str = "event_time") -> Column:
    """Epoch microseconds of a TIMESTAMP or TIMESTAMP_NTZ column."""
    if isinstance(df.schema[col].dataType, T.TimestampNTZType):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_diff("MICROSECOND", epoch, F.col(col))
    return F.unix_micros(F.col(col))


def floor_bucket(micros: Column, width_us: int) -> Column:
    """``floor(micros / width)`` in exact integer arithmetic (negatives too)."""
    return F.call_function("div", micros - F.pmod(micros, F.lit(width_us)), F.lit(width_us))


# --------------------------------------------------------------------------
# Zone occupancy
# --------------------------------------------------------------------------

def zone_occupancy(enriched: DataFrame, size: str = ZONE_WINDOW) -> DataFrame:
    """Tumbling-window occupancy per (zone, status).

    Level 1 groups by (window, zone, status, driver); level 2 regroups on the
    same window column, counting level-1 rows as distinct drivers.
    """
    lvl1 = (enriched
            .withColumn("_exact", exact_speed("speed_kmh"))
            .groupBy(F.window("event_time", size).alias("window"), "h3_cell", "status", "driver_id")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.sum("_exact").alias("s"),
                 F.count("_exact").alias("ns"),
                 F.max(finite_speed()).alias("mx"),
                 F.min(finite_speed()).alias("mn"),
                 F.count_if(F.col("status") == STATUS_ON_TRIP).alias("trips")))
    lvl2 = (lvl1.groupBy("window", "h3_cell", "status")
            .agg(F.sum("n").alias("ping_count"),
                 F.count("driver_id").alias("unique_drivers"),
                 F.sum("s").alias("s"), F.sum("ns").alias("ns"),
                 F.max("mx").alias("mx"), F.min("mn").alias("mn"),
                 F.sum("trips").alias("on_trip_count")))
    return lvl2.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "h3_cell", "status", "ping_count", "unique_drivers",
        exact_mean_2dp("s", "ns").alias("avg_speed"),
        F.round("mx", 2).alias("max_speed"),
        F.round("mn", 2).alias("min_speed"),
        "on_trip_count",
        exact_percent_2dp("on_trip_count", "ping_count").alias("on_trip_percentage"),
    )


# --------------------------------------------------------------------------
# Fleet metrics
# --------------------------------------------------------------------------

def _metric_rows(enriched: DataFrame, window_col: Column) -> DataFrame:
    """One row per ping and distinct kind: ``d`` carries the driver and every
    additive measure, ``z`` carries the zone with zero measures."""
    is_trip = F.when(F.col("status") == STATUS_ON_TRIP, 1).otherwise(0).cast("bigint")
    is_anom = F.when(F.col("anomaly_type") != ANOMALY_NORMAL, 1).otherwise(0).cast("bigint")
    kinds = F.array(
        F.struct(F.lit("d").alias("kind"), F.col("driver_id").alias("value"),
                 F.lit(1).cast("bigint").alias("n"), is_trip.alias("trips"), is_anom.alias("anoms")),
        F.struct(F.lit("z").alias("kind"), F.col("h3_cell").alias("value"),
                 F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("trips"),
                 F.lit(0).cast("bigint").alias("anoms")),
    )
    return enriched.select(window_col.alias("window"), F.inline(kinds))


def _metric_levels(rows: DataFrame) -> DataFrame:
    lvl1 = rows.groupBy("window", "kind", "value").agg(
        F.sum("n").alias("n"), F.sum("trips").alias("trips"), F.sum("anoms").alias("anoms"))
    return lvl1.groupBy("window").agg(
        F.sum("n").alias("total_events"),
        F.count_if((F.col("kind") == "d") & F.col("value").isNotNull()).alias("active_drivers"),
        F.count_if((F.col("kind") == "z") & F.col("value").isNotNull()).alias("active_zones"),
        F.sum("trips").alias("trips_count"),
        F.sum("anoms").alias("anomalies_count"))


def _metric_select(agg: DataFrame, start_alias: str, with_end: bool) -> DataFrame:
    cols = [F.col("window.start").alias(start_alias)]
    if with_end:
        cols.append(F.col("window.end").alias("window_end"))
    return agg.select(
        *cols, "total_events", "active_drivers", "active_zones", "trips_count",
        "anomalies_count",
        exact_percent_2dp("anomalies_count", "total_events").alias("anomaly_rate_percent"))


def perf_metrics(enriched: DataFrame, size: str = METRIC_WINDOW) -> DataFrame:
    """Fleet health per tumbling window: events, distinct drivers and zones,
    on-trip pings, anomalies and the anomaly rate."""
    rows = _metric_rows(enriched, F.window("event_time", size))
    return _metric_select(_metric_levels(rows), "metric_window", with_end=False)


def micros_as_time(micros: Column, like: DataFrame, col: str = "event_time") -> Column:
    """Epoch microseconds back to the timestamp type of ``like[col]``."""
    if isinstance(like.schema[col].dataType, T.TimestampNTZType):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_add("MICROSECOND", micros, epoch)
    return F.timestamp_micros(micros)


def prefix_sums(df: DataFrame, key: str, values: list[str], block: int = 4096) -> DataFrame:
    """``df`` with the ``values`` replaced by their running sums in ``key`` order (keys are
    distinct), computed blockwise: a window per block of ``block`` consecutive keys, plus
    each block's offset from a table with one row per block.  No single task sees
    all keys, and both parts read the one shuffle that ``df`` ends with."""
    blocks = df.withColumn("_blk", floor_bucket(F.col(key), block))
    inside = Window.partitionBy("_blk").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    totals = blocks.groupBy("_blk").agg(*(F.sum(v).alias(v) for v in values))
    offsets = totals.select("_blk", *(F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"_off_{v}") for v in values))
    local = blocks.withColumns({v: F.sum(v).over(inside) for v in values})
    return local.join(offsets, "_blk").select(key, *((F.col(v) + F.col(f"_off_{v}")).alias(v) for v in values))


_SLIDING = {"total_events": "n", "trips_count": "trips", "anomalies_count": "anoms", "active_drivers": "drivers", "active_zones": "zones"}


def _sliding_by_changes(enriched: DataFrame, k: int, slide_us: int) -> DataFrame:
    """Metrics of every sliding window of ``k`` panes that has pings (``_w``: its first pane),
    from one pass over the pings and without copying them to windows.

    Pings are reduced to one row for each (pane, kind, value), see ``_metric_rows``.  Such a
    row of pane ``p`` lies in the windows ``p-k+1 .. p``: its counts come in at the first and
    go out behind the last.  A distinct value comes in at its pane's first window, but not
    before the one behind its previous pane ``q``, which it is still counted in.  The running
    sums of these changes over the window index are the metrics.  Windows without a change
    of their own get a row of zeros from the pane that opens them.
    """
    x = enriched.filter(F.col("event_time").isNotNull())
    cells = _metric_rows(x, floor_bucket(time_micros(x), slide_us)).groupBy(F.col("window").alias("_p"), "kind", "value").agg(
        F.sum("n").alias("n"), F.sum("trips").alias("trips"), F.sum("anoms").alias("anoms"))
    before = F.lag("_p").over(Window.partitionBy("kind", "value").orderBy("_p"))
    first = F.col("_p") - (k - 1)
    counted = lambda kind: F.when((F.col("kind") == kind) & F.col("value").isNotNull(), 1).otherwise(0).cast("bigint")
    cells = cells.withColumns({"_q": before, "drivers": counted("d"), "zones": counted("z")})
    start = F.when(F.col("_q").isNull(), first).otherwise(F.greatest(first, F.col("_q") + 1))
    zero, names = F.lit(0).cast("bigint"), list(_SLIDING.values())

    def change(window: Column, sign: int | None, *of: str) -> Column:
        return F.struct(window.alias("_w"), *((F.col(n) * sign if n in of else zero).alias(n) for n in names),
                        (F.col("n") > 0 if sign == 1 and "n" in of else F.lit(False)).alias("_opens"))

    changes = cells.select(F.inline(F.array(change(first, 1, "n", "trips", "anoms"), change(start, 1, "drivers", "zones"),
                                            change(F.col("_p") + 1, -1, *names))))
    sums = [F.sum(n).alias(n) for n in names]
    by_window = changes.groupBy("_w").agg(*sums, F.max("_opens").alias("_opens"))
    own = F.struct("_w", *names)
    opened = F.when(F.col("_opens"), F.transform(F.sequence(F.lit(1), F.lit(k - 1)), lambda i: F.struct(
        (F.col("_w") + i).alias("_w"), *(zero.alias(n) for n in names)))).otherwise(F.array().cast(
            "array<struct<_w:bigint," + ",".join(f"{n}:bigint" for n in names) + ">>"))
    rows = by_window.select(F.inline(F.concat(F.array(own), opened) if k > 1 else F.array(own))).groupBy("_w").agg(*sums)
    return prefix_sums(rows, "_w", names).filter("n > 0").withColumnsRenamed({v: k_ for k_, v in _SLIDING.items()})


def perf_metrics_sliding(enriched: DataFrame, size: str = METRIC_WINDOW,
                         slide: str = METRIC_SLIDE, method: str | None = None) -> DataFrame:
    """Fleet health per sliding window (1 min every 10 s by default).

    ``method``:

    * ``"delta"`` (batch default): one pass reduces the pings to (pane, kind, value) rows, whose
      comings and goings are summed up along the windows (``_sliding_by_changes``); no row
      is copied per window.
    * ``"panes"`` (stream default): pings reduced per (pane, kind, value), the
      partial rows fanned out with Spark's sliding window over
      ``window_time(pane)``, which also carries the watermark, so the chain of
      three aggregations runs on a stream in append mode.
    * ``"plain"``: Spark's per-ping sliding ``window``.
    """
    size_us, slide_us = duration_micros(size), duration_micros(slide)
    if method is None:
        method = "panes" if enriched.isStreaming else "delta"
    if size_us % slide_us != 0:
        method = "plain"
    if method == "plain":
        rows = _metric_rows(enriched, F.window("event_time", size, slide))
        return _metric_select(_metric_levels(rows), "window_start", with_end=True)
    if method == "panes":
        pane_rows = _metric_rows(enriched, F.window("event_time", slide))
        per_pane = pane_rows.groupBy("window", "kind", "value").agg(
            F.sum("n").alias("n"), F.sum("trips").alias("trips"), F.sum("anoms").alias("anoms"))
        # A pane [p, p+slide) lies in exactly the sliding windows containing
        # its last instant, window_time(pane).
        fanned = per_pane.select(
            F.window(F.window_time("window"), size, slide).alias("window"),
            "kind", "value", "n", "trips", "anoms")
        return _metric_select(_metric_levels(fanned), "window_start", with_end=True)
    out = _sliding_by_changes(enriched, size_us // slide_us, slide_us)
    start = micros_as_time(F.col("_w") * slide_us, enriched)
    return out.select(
        start.alias("window_start"),
        F.timestamp_add("MICROSECOND", F.lit(size_us), start).alias("window_end"),
        *METRIC_COLUMNS[:-1],
        exact_percent_2dp("anomalies_count", "total_events").alias("anomaly_rate_percent"))


# --------------------------------------------------------------------------
# Trip sessions
# --------------------------------------------------------------------------

def session_columns(agg: DataFrame, gap_us: int) -> DataFrame:
    return agg.select(
        "driver_id",
        F.col("tmin").alias("trip_start"),
        F.timestamp_add("MICROSECOND", F.lit(gap_us), F.col("tmax")).alias("trip_end"),
        F.col("n").alias("total_pings"),
        exact_mean_2dp("s", "ns").alias("avg_speed_during_trip"),
        F.round("maxlat", 6).alias("max_latitude"),
        F.round("maxlon", 6).alias("max_longitude"),
        F.round("minlat", 6).alias("min_latitude"),
        F.round("minlon", 6).alias("min_longitude"),
        F.col("cells").alias("h3_cells_visited"),
        F.col("maxdur").alias("max_trip_duration"),
    )


def trip_sessions(enriched: DataFrame, gap: str = SESSION_GAP) -> DataFrame:
    """Session-gap trips per driver over on-trip pings (batch form).

    A driver's timeline is cut into gap-wide time buckets.  Two pings in one
    bucket are less than a gap apart, so each (driver, bucket) is a piece of
    exactly one session: pings are first aggregated per (driver, bucket,
    zone) with map-side combine, which splits a hot driver by time.  A window
    over the much smaller bucket rows (at most span/gap per driver) marks a
    bucket that starts a new session, when its first ping is more than a gap
    after the previous bucket's last ping; the session key is the start
    bucket.  ``trip_start`` / ``trip_end`` are min(time) and max(time) + gap
    as plain aggregates, so filters on them after this operator are safe.
    """
    gap_us = duration_micros(gap)
    p = on_trip_pings(enriched)
    t = time_micros(p)
    pieces = (p.withColumns({"_t": t, "_exact": exact_speed("speed_kmh")})
              .withColumn("_b", floor_bucket(F.col("_t"), gap_us))
              .groupBy("driver_id", "_b", "h3_cell")
              .agg(F.count(F.lit(1)).alias("n"), F.sum("_exact").alias("s"),
                   F.count("_exact").alias("ns"),
                   F.max("latitude").alias("maxlat"), F.max("longitude").alias("maxlon"),
                   F.min("latitude").alias("minlat"), F.min("longitude").alias("minlon"),
                   F.max("trip_duration_secs").alias("maxdur"),
                   F.min("event_time").alias("tmin"), F.max("event_time").alias("tmax"),
                   F.min("_t").alias("tmin_us"), F.max("_t").alias("tmax_us")))
    w = Window.partitionBy("driver_id").orderBy("_b")
    first_in_bucket = F.min("tmin_us").over(w.rangeBetween(0, 0))
    last_before = F.max("tmax_us").over(w.rangeBetween(Window.unboundedPreceding, -1))
    marked = pieces.withColumn(
        "_new", last_before.isNull() | (first_in_bucket - last_before > F.lit(gap_us)))
    keyed = marked.withColumn(
        "_sid", F.max(F.when(F.col("_new"), F.col("_b"))).over(
            w.rangeBetween(Window.unboundedPreceding, 0)))
    per_cell = keyed.groupBy("driver_id", "_sid", "h3_cell").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ns").alias("ns"),
        F.max("maxlat").alias("maxlat"), F.max("maxlon").alias("maxlon"),
        F.min("minlat").alias("minlat"), F.min("minlon").alias("minlon"),
        F.max("maxdur").alias("maxdur"), F.min("tmin").alias("tmin"), F.max("tmax").alias("tmax"))
    sessions = per_cell.groupBy("driver_id", "_sid").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ns").alias("ns"),
        F.max("maxlat").alias("maxlat"), F.max("maxlon").alias("maxlon"),
        F.min("minlat").alias("minlat"), F.min("minlon").alias("minlon"),
        F.max("maxdur").alias("maxdur"), F.min("tmin").alias("tmin"), F.max("tmax").alias("tmax"),
        F.count("h3_cell").alias("cells"))
    return session_columns(sessions, gap_us)


def on_trip_pings(pings: DataFrame) -> DataFrame:
    return pings.filter(F.col("status") == STATUS_ON_TRIP)
