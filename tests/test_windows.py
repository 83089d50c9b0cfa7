import datetime as dt

from pyspark.sql import functions as F

from geopulse.operators import enrich as E
from geopulse.operators import windows as W

T0 = dt.datetime(2026, 5, 17, 0, 0, 0)


def pings(spark, times, status="on_trip", driver="DRV_1"):
    rows = [(i, driver, 28.6139, 77.209, status, 10.0, 0, t) for i, t in enumerate(times)]
    schema = ("ping_id long, driver_id string, latitude double, longitude double, status string, "
              "speed_kmh double, trip_duration_secs int, event_time timestamp_ntz")
    return E.enrich(spark.createDataFrame(rows, schema))


def test_session_gap_edges(spark):
    times = [T0, T0 + dt.timedelta(minutes=5), T0 + dt.timedelta(minutes=10, milliseconds=1)]
    out = W.trip_sessions(pings(spark, times)).orderBy("trip_start").collect()
    assert [r.total_pings for r in out] == [2, 1]
    assert out[0].trip_end == T0 + dt.timedelta(minutes=10)


def test_session_filter_on_end_keeps_whole_sessions(spark):
    times = [T0 + dt.timedelta(minutes=2 * i) for i in range(6)]
    s = W.trip_sessions(pings(spark, times))
    assert s.filter(F.col("trip_end") <= T0 + dt.timedelta(minutes=9)).count() == 0
    assert s.filter(F.col("trip_start") >= T0 + dt.timedelta(minutes=3)).count() == 0
    (row,) = s.collect()
    assert row.total_pings == 6 and row.trip_end == T0 + dt.timedelta(minutes=15)


def test_sessions_across_bucket_boundaries_and_drivers(spark):
    # pings every 4 min for an hour: one session crossing many 5-min buckets
    times = [T0 + dt.timedelta(minutes=4 * i) for i in range(16)]
    a = pings(spark, times)
    b = pings(spark, [T0, T0 + dt.timedelta(minutes=6)], driver="DRV_2")
    out = {(r.driver_id, r.total_pings) for r in W.trip_sessions(a.unionByName(b)).collect()}
    assert out == {("DRV_1", 16), ("DRV_2", 1)}


def test_sessions_ignore_available_pings(spark):
    times = [T0, T0 + dt.timedelta(minutes=1)]
    assert W.trip_sessions(pings(spark, times, status="available")).count() == 0


def test_null_event_time_not_windowed(spark):
    df = pings(spark, [T0, None])
    z = W.zone_occupancy(df).collect()
    assert sum(r.ping_count for r in z) == 1


def test_tumbling_boundary_goes_to_next_window(spark):
    times = [T0 + dt.timedelta(seconds=29, microseconds=999999), T0 + dt.timedelta(seconds=30)]
    z = W.zone_occupancy(pings(spark, times)).orderBy("window_start").collect()
    assert [r.window_start for r in z] == [T0, T0 + dt.timedelta(seconds=30)]


def test_sliding_methods_agree(spark):
    from geopulse.plans import batch
    e = batch.enriched(spark, "/root/testdata/sf0.01")
    plain = W.perf_metrics_sliding(e, method="plain")
    for method in ("panes", "delta"):
        other = W.perf_metrics_sliding(e, method=method)
        assert plain.exceptAll(other).count() == 0 and other.exceptAll(plain).count() == 0, method


def test_prefix_sums_across_blocks(spark):
    df = spark.range(0, 50).select((F.col("id") * 3 - 30).alias("k"), F.lit(2).cast("bigint").alias("v"), F.col("id").alias("u"))
    got = {r.k: (r.v, r.u) for r in W.prefix_sums(df, "k", ["v", "u"], block=7).collect()}
    assert got == {3 * i - 30: (2 * (i + 1), i * (i + 1) // 2) for i in range(50)}


def test_zone_counts_sum_to_metric_counts(spark):
    from geopulse.plans import batch
    e = batch.enriched(spark, "/root/testdata/sf0.001")
    zones = W.zone_occupancy(e).agg(F.sum("ping_count")).first()[0]
    metrics = W.perf_metrics(e).agg(F.sum("total_events")).first()[0]
    assert zones == metrics == e.count()
