"""Per-driver sequence operators: previous ping (lag), haversine legs,
derived speed (F1, F2) and status segments / trips (F3, F4).

A driver's pings are ordered by ``(event_time, ping_id)``.  One window over a
driver's whole history would put a driver holding a large share of all pings
into a single task, so the timeline is salted by a time bucket and the ordered
window runs per (driver, bucket).

What crosses a bucket edge is carried by **boundary rows**, not by a join:

1. a per-(driver, bucket) summary — last ping, first status, whether the
   bucket holds one status only — is computed with map-side partial
   aggregation (one row per driver and bucket);
2. a window over that small table finds, for each bucket, the last ping of the
   nearest earlier non-empty bucket; it is added to the bucket's rows as a
   marker row.  Its time precedes every row of the bucket, so a plain
   ``lag`` gives the first ping its true predecessor;
3. one exchange by (driver, bucket) and one sort feed the ordered window;
   marker rows are dropped after it.

Status runs that continue across bucket edges are stitched with facts the
summary already holds (see ``trip_segments``), so no second pass over the
windowed pings is needed.  The bucket width is a parameter; nothing about the
data is counted while a query is built, and the plan never changes with size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import haversine_km, km_to_micros, micros_to_km
from .windows import duration_micros, floor_bucket, time_micros

#: Width of a (driver, bucket) window partition; the plan is the same at every size.  A driver that pings
#: every 2 to 5 seconds has 720 to 1,800 pings in it, so the summary is far smaller than the pings.
DEFAULT_BUCKET = "1 hour"

ROW_FIELDS = ["latitude", "longitude", "status", "event_time", "_t", "ping_id"]
_LAST = (2**63) - 1  # key of "the run that ends a bucket"


def _bucketed(pings: DataFrame, bucket: str) -> DataFrame:
    """Pings with known event time, plus ``_t`` (epoch µs) and its time bucket ``_b``.

    Rows with NULL event time cannot be ordered; the decode step quarantines
    them before they get here."""
    p = pings.filter(F.col("event_time").isNotNull())
    p = p.withColumn("_t", time_micros(p))
    return p.withColumn("_b", floor_bucket(F.col("_t"), duration_micros(bucket)))


def _order_key() -> Column:
    return F.struct(F.col("_t").alias("t"), F.col("ping_id").alias("id"))


def _summary(p: DataFrame, with_status: bool) -> DataFrame:
    """One row per (driver, bucket): the last ping and, for status runs, the
    first status and whether all statuses of the bucket are equal."""
    aggs = [F.max_by(F.struct(*ROW_FIELDS), _order_key()).alias("last")]
    if with_status:
        n, n_status = F.count(F.lit(1)), F.count("status")
        aggs += [
            F.min_by("status", _order_key()).alias("first_status"),
            ((n_status == 0) | ((n_status == n) & (F.min("status") == F.max("status"))))
            .alias("single_status"),
        ]
    return p.groupBy("driver_id", "_b").agg(*aggs)


def _with_markers(p: DataFrame, with_status: bool) -> DataFrame:
    """``p`` plus one marker row per bucket that has an earlier non-empty
    bucket: the previous bucket's last ping, flagged ``_marker``.  For status
    runs the marker also carries ``_m_cont`` (the bucket's first run continues
    the previous bucket's last run) and ``_m_chain`` (the bucket whose last
    run that is)."""
    s = _summary(p, with_status)
    w = Window.partitionBy("driver_id").orderBy("_b")
    s = s.withColumn("_prev", F.lag("last").over(w))
    extra = {}
    if with_status:
        cont = F.col("_prev").isNotNull() & F.col("first_status").eqNullSafe(F.col("_prev.status"))
        s = s.withColumn("_cont", cont)
        # A bucket whose single run continues from the one before passes the
        # run through; the chain start is the latest earlier bucket that does not.
        passes = F.col("single_status") & F.col("_cont")
        s = s.withColumn("_chain", F.max(F.when(~passes, F.col("_b"))).over(
            w.rangeBetween(Window.unboundedPreceding, -1)))
        extra = {"_m_cont": F.col("_cont"), "_m_chain": F.col("_chain")}
    markers = (s.filter(F.col("_prev").isNotNull())
               .select("driver_id", "_b", *[F.col(f"_prev.{c}").alias(c) for c in ROW_FIELDS],
                       F.lit(True).alias("_marker"),
                       *[v.alias(k) for k, v in extra.items()]))
    rows = p.select("driver_id", "_b", *ROW_FIELDS, F.lit(False).alias("_marker"),
                    *[F.lit(None).cast(t).alias(k)
                      for k, t in (("_m_cont", "boolean"), ("_m_chain", "bigint")) if k in extra])
    return rows.unionByName(markers)


def _ordered_window() -> Window:
    return Window.partitionBy("driver_id", "_b").orderBy("_t", "ping_id")


def with_previous(pings: DataFrame, bucket: str = DEFAULT_BUCKET) -> DataFrame:
    """Pings with ``prev_*`` columns: the previous ping of the same driver
    (NULL for the driver's first ping).  One shuffle of the pings."""
    p = _bucketed(pings, bucket)
    u = _with_markers(p, with_status=False)
    w = _ordered_window()
    out = u.withColumns({f"prev_{c}": F.lag(c).over(w) for c in ROW_FIELDS})
    return out.filter(~F.col("_marker")).drop("_marker")


def haversine_legs(pings: DataFrame, bucket: str = DEFAULT_BUCKET) -> DataFrame:
    """Distance from each ping's predecessor, km rounded to 6 digits (NULL first)."""
    p = with_previous(pings, bucket)
    km = haversine_km("prev_latitude", "prev_longitude", "latitude", "longitude")
    return p.select("ping_id", "driver_id", "event_time",
                    F.round(km, 6).alias("distance_km"))


def derived_speed(pings: DataFrame, bucket: str = DEFAULT_BUCKET) -> DataFrame:
    """Speed over the leg from the previous ping: km / seconds * 3600, 2 digits,
    0 when the interval is not positive, NULL for a driver's first ping."""
    # distance and interval as columns: each is used inside and outside a
    # CASE branch, which subexpression elimination would not share
    p = with_previous(pings, bucket).withColumns({
        "_km": haversine_km("prev_latitude", "prev_longitude", "latitude", "longitude"),
        "_secs": (F.col("_t") - F.col("prev__t")) / F.lit(1e6)})
    km, secs = F.col("_km"), F.col("_secs")
    speed = F.when(F.col("prev__t").isNull(), F.lit(None).cast("double")) \
        .when(secs > 0, F.round(km / secs * 3600.0, 2)).otherwise(F.lit(0.0))
    return p.select("ping_id", "driver_id", "event_time",
                    F.round(km, 6).alias("distance_km"),
                    secs.alias("seconds_since_prev"),
                    speed.alias("derived_speed_kmh"))


SEGMENT_COLUMNS = ["driver_id", "status", "segment_start", "segment_end", "pings",
                   "distance_km", "duration_secs"]


def trip_segments(pings: DataFrame, bucket: str = DEFAULT_BUCKET) -> DataFrame:
    """Runs of equal status per driver (the available → on_trip → available
    state machine), with start, end, pings, distance and duration.

    A run starts at a driver's first ping and wherever the status differs
    (NULL-safe) from the previous ping.  Inside a bucket, each row gets the
    key of its local run (row 1 of a bucket always opens one).  Runs crossing
    bucket edges are stitched by key alone:

    * the last local run of bucket ``b`` is keyed ``(b, LAST)``;
    * the first local run of ``b``, when it continues the previous bucket's
      last run, is keyed ``(c, LAST)``, ``c`` being the latest earlier bucket
      whose last run does not itself continue through a single-status bucket;
    * every other run is keyed ``(b, its first ping)``.

    Distance sums the legs whose both ends are in the run (the leg into a
    continuing bucket included), in integer micro-km so the sum does not
    depend on row order.
    """
    p = _bucketed(pings, bucket)
    u = _with_markers(p, with_status=True)
    w = _ordered_window()
    everything = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    u = u.withColumns({
        "_ps": F.lag("status").over(w), "_pt": F.lag("_t").over(w),
        "_plat": F.lag("latitude").over(w), "_plon": F.lag("longitude").over(w),
        "_pm": F.lag("_marker").over(w),
        "_cont": F.max("_m_cont").over(everything),
        "_chain": F.max("_m_chain").over(everything),
    })
    changed = F.col("_pt").isNull() | ~F.col("status").eqNullSafe(F.col("_ps"))
    first_row = F.col("_pt").isNull() | F.col("_pm")
    start = F.when(~F.col("_marker") & (first_row | changed), _order_key())
    u = u.withColumns({"_changed": changed, "_start": start})
    u = u.withColumns({
        "_run": F.max("_start").over(w.rowsBetween(Window.unboundedPreceding, 0)),
        "_first_run": F.min("_start").over(everything),
        "_last_run": F.max("_start").over(everything),
    })
    rows = u.filter(~F.col("_marker"))
    last_of = lambda b: F.struct(b.alias("b"), F.lit(_LAST).alias("t"), F.lit(_LAST).alias("id"))
    key = (F.when((F.col("_run") == F.col("_first_run")) & F.coalesce(F.col("_cont"), F.lit(False)),
                  last_of(F.col("_chain")))
           .when(F.col("_run") == F.col("_last_run"), last_of(F.col("_b")))
           .otherwise(F.struct(F.col("_b").alias("b"), F.col("_run.t").alias("t"),
                               F.col("_run.id").alias("id"))))
    leg = F.when(~F.col("_changed"),
                 km_to_micros(haversine_km("_plat", "_plon", "latitude", "longitude")))
    # status is constant within a run (NULL-safe), so it can be a grouping
    # key: the aggregate buffers stay fixed-width and Spark hash-aggregates.
    agg = rows.withColumns({"_seg": key, "_leg": leg}).groupBy("driver_id", "_seg", "status").agg(
        F.min("event_time").alias("segment_start"),
        F.max("event_time").alias("segment_end"),
        F.count(F.lit(1)).alias("pings"),
        F.coalesce(F.sum("_leg"), F.lit(0)).alias("_dist"),
        F.min("_t").alias("_t0"), F.max("_t").alias("_t1"))
    return agg.select(
        "driver_id", "status", "segment_start", "segment_end", "pings",
        micros_to_km("_dist").alias("distance_km"),
        ((F.col("_t1") - F.col("_t0")) / F.lit(1e6)).alias("duration_secs"))
