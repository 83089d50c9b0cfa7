"""Properties over real rows: input order does not matter; segments cover
every ping once."""
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from geopulse.operators import trips as TR
from geopulse.operators import windows as W
from geopulse.plans import batch

SF = "/root/testdata/sf0.001"


@settings(max_examples=3, deadline=None)
@given(st.integers(min_value=1, max_value=16), st.integers(min_value=0, max_value=10**6))
def test_zone_result_independent_of_partitioning(spark, parts, seed):
    e = batch.enriched(spark, SF)
    shuffled = e.repartition(parts).orderBy(F.rand(seed))
    a, b = W.zone_occupancy(e), W.zone_occupancy(shuffled)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@settings(max_examples=2, deadline=None)
@given(st.sampled_from(["1 minute", "10 minutes", "1 hour", "1 day"]))
def test_segments_cover_each_ping_once_any_bucket(spark, bucket):
    p = batch.pings(spark, SF)
    seg = TR.trip_segments(p, bucket)
    assert seg.agg(F.sum("pings")).first()[0] == p.count()
    ref = TR.trip_segments(p, "1 hour")
    assert seg.exceptAll(ref).count() == 0


@settings(max_examples=2, deadline=None)
@given(st.sampled_from(["1 minute", "7 minutes", "1 day"]))
def test_derived_speed_independent_of_bucket(spark, bucket):
    p = batch.pings(spark, SF)
    a, b = TR.derived_speed(p, bucket), TR.derived_speed(p, "1 hour")
    assert a.exceptAll(b).count() == 0


@settings(max_examples=2, deadline=None)
@given(st.sampled_from([1, 3, 7]))
def test_flushed_stream_equals_batch_for_any_chunking(spark, chunks):
    from geopulse.operators import enrich as E
    from geopulse.streaming.replay import read_output, run_replay, to_ntz
    p = batch.pings(spark, SF)
    run = run_replay(spark, p, lambda s: W.zone_occupancy(E.enrich(s)), "t-chunks", chunks=chunks, flush="time")
    got = to_ntz(read_output(spark, run))
    want = W.zone_occupancy(E.enrich(p))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


@pytest.mark.parametrize("name", ["perf_metrics", "perf_metrics_sliding", "trip_sessions",
                                  "trip_segments", "derived_speed", "live_state", "zone_counts"])
def test_batch_results_independent_of_input_order(spark, name):
    from geopulse.operators import enrich as E
    from geopulse.operators import live as L
    ops = {
        "perf_metrics": lambda p: W.perf_metrics(E.enrich(p)),
        "perf_metrics_sliding": lambda p: W.perf_metrics_sliding(E.enrich(p)),
        "trip_sessions": lambda p: W.trip_sessions(E.enrich(p)),
        "trip_segments": lambda p: TR.trip_segments(p),
        "derived_speed": lambda p: TR.derived_speed(p),
        "live_state": lambda p: L.live_state(E.enrich(p)),
        "zone_counts": lambda p: E.zone_counts(E.enrich(p)),
    }
    p = batch.pings(spark, SF)
    shuffled = p.repartition(7).orderBy(F.rand(11))
    a, b = ops[name](p), ops[name](shuffled)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 400_000), st.sampled_from(["z", "y", None]),
                          st.booleans()), min_size=1, max_size=60))
def test_sliding_metrics_equal_brute_force(spark, seen):
    """Sums of changes along the windows == counts and distinct values of each window counted directly."""
    import datetime as dt

    from geopulse.operators import windows as Wn
    t0 = dt.datetime(2026, 5, 17)
    rows = [(d, z, "on_trip" if trip else "available", "NORMAL", t0 + dt.timedelta(milliseconds=ms)) for d, ms, z, trip in seen]
    x = spark.createDataFrame(rows, "driver_id string, h3_cell string, status string, anomaly_type string, event_time timestamp_ntz")
    got = {(r.window_start - t0).total_seconds(): (r.total_events, r.active_drivers, r.active_zones, r.trips_count)
           for r in Wn.perf_metrics_sliding(x).collect()}
    want = {}
    for start in range(-60, 410, 10):
        inside = [r for r in seen if start * 1000 <= r[1] < (start + 60) * 1000]
        if inside:
            want[start] = (len(inside), len({d for d, *_ in inside} - {None}), len({z for _, _, z, _ in inside} - {None}),
                           sum(trip for *_, trip in inside))
    assert got == want
