import datetime as dt

from pyspark.sql import functions as F

from geopulse.operators import enrich as E
from geopulse.operators import windows as W
from geopulse.plans import batch
from geopulse.streaming.replay import dropped_by_watermark, read_output, run_replay, to_ntz
from geopulse.streaming.stateful import live_state_stream

SF = "/root/testdata/sf0.001"
T0 = dt.datetime(2026, 5, 17, 0, 0, 0)
SCHEMA = ("ping_id long, driver_id string, latitude double, longitude double, status string, "
          "speed_kmh double, trip_duration_secs int, event_time timestamp_ntz")


def test_late_chunk_is_dropped_and_counted(spark):
    p = batch.pings(spark, SF)
    run = run_replay(spark, p, lambda s: W.zone_occupancy(E.enrich(s)), "t-late",
                     chunks=4, order=[0, 2, 1, 3])
    from geopulse.streaming.replay import time_chunks
    from geopulse.sources.events import to_stream_time
    b = time_chunks(to_stream_time(p), 4)
    us = F.unix_micros(F.col("event_time").cast("timestamp"))
    late_rows = p.filter((us >= b[0]) & (us < b[1])).count()
    assert late_rows > 0
    assert 0 < dropped_by_watermark(run) <= late_rows
    out = to_ntz(read_output(spark, run))
    lo, hi = [F.lit(x).cast("long") for x in (b[0], b[1])]
    w_end = F.unix_micros(F.col("window_end").cast("timestamp"))
    w_start = F.unix_micros(F.col("window_start").cast("timestamp"))
    # windows lying wholly inside the late chunk never appear
    assert out.filter((w_start >= lo) & (w_end <= hi)).count() == 0
    assert out.agg(F.sum("ping_count")).first()[0] <= p.count() - late_rows


def test_live_state_tie_prefers_larger_ping_id(spark):
    rows = [(1, "DRV_1", 28.61, 77.20, "available", 5.0, 0, T0),
            (2, "DRV_1", 28.62, 77.21, "on_trip", 6.0, 0, T0),
            (3, "DRV_2", 28.63, 77.22, "on_trip", 7.0, 0, T0 + dt.timedelta(seconds=5))]
    p = spark.createDataFrame(rows, SCHEMA)
    run = run_replay(spark, p, lambda s: live_state_stream(E.enrich(s)), "t-live", chunks=1)
    out = to_ntz(read_output(spark, run)).filter(F.col("driver_id") == "DRV_1").collect()
    assert [r.ping_id for r in out if r.state == "LIVE"][-1] == 2


def test_live_state_expires_after_ttl(spark):
    rows = [(1, "DRV_1", 28.61, 77.20, "available", 5.0, 0, T0),
            (2, "DRV_2", 28.62, 77.21, "on_trip", 6.0, 0, T0 + dt.timedelta(seconds=100))]
    p = spark.createDataFrame(rows, SCHEMA)
    run = run_replay(spark, p, lambda s: live_state_stream(E.enrich(s)), "t-expiry", chunks=2)
    out = {(r.driver_id, r.state) for r in read_output(spark, run).collect()}
    assert ("DRV_1", "EXPIRED") in out and ("DRV_2", "EXPIRED") not in out


def test_restart_no_duplicates(spark):
    p = batch.pings(spark, SF)
    run = run_replay(spark, p, None, "t-restart", chunks=5)
    back = to_ntz(read_output(spark, run))
    assert back.count() == p.count()
    assert back.select("ping_id").distinct().count() == p.count()


def _cache_rows(rows):
    return sorted((r.key, r.value) for r in rows)


def test_keyed_table_takes_batches_in_any_order_and_again(spark):
    """Older, repeated and half-written batches leave the newest version of every key."""
    from geopulse.operators import live as L
    from geopulse.session import scratch_dir
    from geopulse.sinks.cache import KeyedTable, versioned_records

    e = E.enrich(batch.pings(spark, SF)).withColumn("part", F.pmod(F.xxhash64("ping_id"), F.lit(3)))
    table = KeyedTable(scratch_dir(spark, "t-cache"), shards=3)
    assert table.read(spark).count() == 0
    for batch_id, part in ((0, 2), (1, 0), (1, 0), (2, 1), (0, 2)):
        table.upsert(versioned_records(e.where(F.col("part") == part)), batch_id)
    assert _cache_rows(table.read(spark).collect()) == _cache_rows(L.cache_records(e).collect())
    table.upsert(versioned_records(e.limit(0)), 3)
    last = e.agg(F.max("event_time")).first()[0]
    alive = table.read(spark, F.lit(last)).count()
    assert 0 < alive < table.read(spark).count()  # the others' 60 seconds are over


def test_external_store_gets_versioned_records(spark, tmp_path):
    import json

    from geopulse.operators import live as L
    from geopulse.sinks.cache import ExternalUpserts, versioned_records

    class FileStore:
        """A key-value store in a folder: one file for each key, written only by a newer version."""

        def __init__(self, folder):
            self.folder = folder

        def put_if_newer(self, key, value, ttl_secs, version, batch_id):
            import json
            import os
            path = os.path.join(self.folder, key.replace(":", "_"))
            if os.path.exists(path):
                with open(path) as f:
                    if tuple(json.load(f)["version"]) >= version:
                        return
            with open(path, "w") as f:
                json.dump({"key": key, "value": value, "ttl": ttl_secs, "version": version}, f)

        def close(self):
            pass

    folder = str(tmp_path)
    e = E.enrich(batch.pings(spark, SF)).withColumn("part", F.pmod(F.xxhash64("ping_id"), F.lit(3)))
    store = ExternalUpserts(lambda: FileStore(folder))
    for batch_id, part in ((0, 2), (1, 0), (2, 1), (1, 0)):
        store.upsert(versioned_records(e.where(F.col("part") == part)), batch_id)
    got = [json.loads(f.read_text()) for f in tmp_path.iterdir()]
    assert sorted((r["key"], r["value"]) for r in got) == _cache_rows(L.cache_records(e).collect())
    assert {r["ttl"] for r in got} == {60}


def _processor_run(spark, processor, keys_rows):
    """The processor over a driver's frames, with its state in dictionaries."""

    class Map(dict):
        def getValue(self, k): return self.get(k)  # noqa: E704
        def containsKey(self, k): return k in self  # noqa: E704
        def updateValue(self, k, v): self[k] = v  # noqa: E704
        def removeKey(self, k): self.pop(k, None)  # noqa: E704
        def iterator(self): return iter(list(self.items()))  # noqa: E704

    class Value:
        v = None
        def get(self): return self.v  # noqa: E704
        def exists(self): return self.v is not None  # noqa: E704
        def update(self, v): self.v = v  # noqa: E704
        def clear(self): self.v = None  # noqa: E704

    class Handle:
        def __init__(self): self.timers, self.maps = set(), {}  # noqa: E704
        def getMapState(self, name, *_): return self.maps.setdefault(name, Map())  # noqa: E704
        def getValueState(self, *_): return Value()  # noqa: E704
        def registerTimer(self, ms): self.timers.add(ms)  # noqa: E704
        def deleteTimer(self, ms): self.timers.discard(ms)  # noqa: E704

    handle = Handle()
    processor.init(handle)
    list(processor.handleInputRows(("d",), iter(keys_rows), None))
    return handle


class _Expired:
    def __init__(self, ms):
        self.ms = ms

    def getExpiryTimeInMs(self):
        return self.ms


def test_a_backlog_is_released_in_bounded_frames_and_in_order(spark):
    """A million pings of one driver, unordered, half of them in one bucket: no frame holds more than its limit."""
    import numpy as np
    import pandas as pd

    from geopulse.streaming import stateful as S

    rng = np.random.default_rng(4)
    n = 1_000_000
    t = np.where(np.arange(n) < n // 2, rng.integers(0, 10_000_000, n), rng.integers(0, 3_600_000_000, n)) + 1_700_000_000_000_000
    frames = [pd.DataFrame({"ping_id": np.arange(i, i + 10_000), "event_time": t[i:i + 10_000].astype("datetime64[us]"), "latitude": 1.0,
                            "longitude": 2.0, "status": "on_trip"}) for i in range(0, n, 10_000)]

    class Seen(S._OrderedRelease):
        sizes, last, total, ordered = [], (0, 0), 0, True

        def setup_state(self, handle):
            pass

        def release(self, driver, ready):
            self.sizes.append(len(ready))
            at, ids = ready["t"].to_numpy(), ready["ping_id"].to_numpy()
            self.ordered &= bool(((np.diff(at) > 0) | ((np.diff(at) == 0) & (np.diff(ids) > 0))).all()) and self.last < (at[0], ids[0])
            self.last, self.total = (at[-1], ids[-1]), self.total + len(ready)

    p = Seen()
    handle = _processor_run(spark, p, frames)
    assert not p.sizes and max(len(v[0]) for v in handle.maps["rows"].values()) < 400_000  # bytes of a stored part
    for ms in sorted(handle.timers):
        list(p.handleExpiredTimer(("d",), None, _Expired(ms)))
    assert p.total == n and p.ordered and max(p.sizes) <= S.RELEASE_ROWS
    assert not handle.maps["rows"] and not handle.maps["parts"]


def test_an_endless_session_keeps_a_row_of_constant_size(spark):
    import numpy as np
    import pandas as pd

    from geopulse.streaming import stateful as S

    def frame(i):
        t = 1_700_000_000_000_000 + (np.arange(i, i + 1000) * 60_000_000)
        return pd.DataFrame({"event_time": t.astype("datetime64[us]"), "latitude": 1.0, "longitude": 2.0, "h3_cell": [f"hx_{i}_{k % 50}" for k in range(1000)],
                             "trip_duration_secs": 5, "nano_speed": 30 * 10**9})

    p = S.SessionProcessor(300_000_000)
    handle = _processor_run(spark, p, [frame(0)])
    small = len(str(handle.maps["sessions"].popitem()))
    p = S.SessionProcessor(300_000_000)
    handle = _processor_run(spark, p, [frame(i) for i in (*range(0, 50_000, 2000), *range(1000, 50_000, 2000))])  # halves out of order
    assert len(handle.maps["sessions"]) == 1
    (sid, row), = handle.maps["sessions"].items()
    assert row[2] == 50_000 and row[10] == 50 * 50 == len(handle.maps["zones"]) and len(str((sid, row))) < small + 20
    assert {k[0] for k in handle.maps["zones"]} == {sid[0]}


class _Watermark:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def _fire(handle, processor, ms):
    """What the shard's timers up to the watermark emit."""
    return [f for t in sorted(x for x in handle.timers if x <= ms) for f in processor.handleExpiredTimer(("d",), _Watermark(ms), _Expired(t))]


def _shard_pings(drivers=300, pings=40):
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(7)
    n = drivers * pings
    return pd.DataFrame({
        "driver_id": np.where(rng.integers(0, drivers, n) == 0, None, [f"d{i % drivers}" for i in range(n)]), "ping_id": rng.permutation(n),
        "event_time": (1_700_000_000_000_000 + rng.integers(0, 21_600, n) * 1_000_000).astype("datetime64[us]"),
        "latitude": rng.integers(0, 3, n) / 100 + 28, "longitude": 77.0, "status": rng.choice(["on_trip", "available", None], n),
        "h3_cell": [f"hx_{i}" for i in rng.integers(0, 9, n)], "speed_kmh": 5.0, "trip_duration_secs": 5, "nano_speed": 30 * 10**9})


def test_one_firing_serves_all_drivers_of_a_shard(spark):
    """12,000 pings of 300 drivers: frames are the shard's, not a driver's, and every driver's order and predecessors hold."""
    import pandas as pd

    from geopulse.streaming import stateful as S

    pings = _shard_pings()
    frames = [pings.iloc[i:i + 5000] for i in range(0, len(pings), 5000)]
    half, end = 1_700_000_000_000 + 10_800_000, 1_700_000_000_000 + 21_700_000
    p = S.PreviousPingProcessor()
    handle = _processor_run(spark, p, frames)
    out = _fire(handle, p, half) + _fire(handle, p, end)
    assert len(out) <= 8
    got = pd.concat(out).sort_values("ping_id").reset_index(drop=True)
    want = pings.sort_values(["event_time", "ping_id"])
    want = want.assign(prev=want.groupby("driver_id", dropna=False)["event_time"].shift()).sort_values("ping_id").reset_index(drop=True)
    assert len(got) == len(pings) and got["driver_id"].tolist() == want["driver_id"].tolist()
    assert got["prev_t"].isna().equals(want["prev"].isna())
    assert (got["prev_t"].dropna() == want["prev"].dropna().astype("int64")).all()
    p = S.SegmentProcessor()
    handle = _processor_run(spark, p, frames)
    closed = pd.concat(_fire(handle, p, half) + _fire(handle, p, end))
    ordered = pings.sort_values(["event_time", "ping_id"])
    runs = 0
    for _, own in ordered.groupby("driver_id", dropna=False):
        status = own["status"].fillna("").tolist()
        runs += sum(a != b for a, b in zip(status, status[1:]))
    assert len(closed) == runs and len(p.last) == pings["driver_id"].nunique(dropna=False)


def test_a_shard_has_one_timer_for_live_state_and_sessions(spark):
    import pandas as pd

    from geopulse.streaming import stateful as S

    pings = _shard_pings()
    frames = [pings.iloc[i:i + 5000] for i in range(0, len(pings), 5000)]
    end = 1_700_000_000_000 + 21_600_000 + 400_000
    drivers = pings["driver_id"].nunique(dropna=False)
    p = S.LiveStateProcessor(60)
    handle = _processor_run(spark, p, frames)
    assert len(handle.timers) == 1
    out = pd.concat(_fire(handle, p, end))
    want = pings.sort_values(["event_time", "ping_id"]).drop_duplicates("driver_id", keep="last")
    assert len(out) == drivers and set(out["ping_id"]) == set(want["ping_id"]) and set(out["state"]) == {"EXPIRED"}
    p = S.SessionProcessor(300_000_000)
    handle = _processor_run(spark, p, frames)
    assert len(handle.timers) == 1 and not handle.maps["sessions"]
    out = pd.concat(_fire(handle, p, end))
    sessions = 0
    for _, own in pings.groupby("driver_id", dropna=False):
        sessions += 1 + int((own["event_time"].sort_values().diff().dt.total_seconds() > 300).sum())
    assert len(out) == sessions and out["n"].sum() == len(pings)


def test_sessions_of_many_zones_leave_the_packed_ones(spark):
    """Two sessions of many zones, some of them common, become one by a ping between; other drivers' stay as they are."""
    import numpy as np
    import pandas as pd

    from geopulse.streaming import stateful as S

    def frame(driver, minutes, cells):
        return pd.DataFrame({"driver_id": driver, "event_time": (1_700_000_000_000_000 + np.array(minutes) * 60_000_000).astype("datetime64[us]"),
                             "latitude": 1.0, "longitude": 2.0, "h3_cell": cells, "trip_duration_secs": 5, "nano_speed": 10**9})

    a, b = list(range(50)), list(range(58, 108))
    p = S.SessionProcessor(300_000_000)
    handle = _processor_run(spark, p, [frame("a", a, [f"x{i}" for i in a]), frame("a", b, [f"x{i - 18}" for i in b]), frame("b", [0, 1], ["x1", None])])
    assert len(handle.maps["sessions"]) == 2
    list(p.handleInputRows(("d",), iter([frame("a", [54], ["y"]), frame("b", [5], ["x2"])]), None))
    assert len(handle.maps["sessions"]) == 1 and len(handle.maps["zones"]) == 91
    out = pd.concat(_fire(handle, p, 1_700_000_000_000 + 200 * 60_000)).set_index("driver_id")
    assert out["n"].to_dict() == {"a": 101, "b": 3} and out["cells"].to_dict() == {"a": 91, "b": 2}
    assert out["total"].to_dict() == {"a": "101.000000000", "b": "3.000000000"}
    assert not handle.maps["sessions"] and not handle.maps["zones"]


def test_sessions_merge_and_edges(spark):
    """Pings exactly a gap apart are one session; a later ping between two sessions makes them one."""
    at = lambda *minutes: [(i, "d", 28.6, 77.2, "on_trip", 10.0, 0, T0 + dt.timedelta(minutes=m)) for i, m in enumerate(minutes)]
    from geopulse.streaming.stateful import trip_sessions_stream
    build = lambda s: trip_sessions_stream(E.enrich(s))
    for minutes, want in (((0, 5, 10.0001), [1, 2]), ((0, 2, 4, 6, 8, 10), [6]), ((0, 9, 4.5), [3])):
        p = spark.createDataFrame(at(*minutes), SCHEMA)
        got = read_output(spark, run_replay(spark, p, build, "t-sessions", chunks=1, flush="time"))
        assert sorted(r.total_pings for r in got.collect()) == want, minutes
        assert got.where(F.col("trip_end") <= F.col("trip_start")).count() == 0


def test_stream_and_batch_sessions_agree(spark):
    from geopulse.streaming.stateful import trip_sessions_stream
    p = batch.pings(spark, SF)
    got = to_ntz(read_output(spark, run_replay(spark, p, lambda s: trip_sessions_stream(E.enrich(s)), "t-sessions", flush="time", swap_us=4_000_000)))
    want = W.trip_sessions(E.enrich(p))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_union_of_sources_by_policy(spark):
    """Under ``min`` the slower source loses nothing; ``max`` drops what it sends into closed windows."""
    from geopulse.streaming import queries as Q
    from geopulse.streaming.replay import run_union_replay
    p = batch.pings(spark, SF)
    counts = {}
    for policy in ("min", "max"):
        run = run_union_replay(spark, Q.two_sources(p), lambda s: W.zone_occupancy(E.enrich(s)), f"t-union-{policy}",
                               [0, 3_600_000_000], policy=policy)
        counts[policy] = read_output(spark, run).agg(F.sum("ping_count")).first()[0]
        assert (dropped_by_watermark(run) > 0) == (policy == "max")
    assert counts["min"] == p.count() > counts["max"]


def test_replays_leave_the_session_alone(spark):
    keys = ("spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass", "spark.sql.streaming.multipleWatermarkPolicy")
    before = [spark.conf.get(k) for k in keys]
    seen = []
    run_replay(spark, batch.pings(spark, SF), lambda s: (seen.append(s.sparkSession.conf.get(keys[0])), live_state_stream(E.enrich(s)))[1],
               "t-settings", chunks=1, state_partitions=3)
    assert [spark.conf.get(k) for k in keys] == before and seen == ["3"]


def test_late_rows_survive_a_rerun(spark):
    """A batch that is run again replaces its late rows; the maximum goes on from the batch before."""
    from geopulse.session import scratch_dir
    from geopulse.streaming.late import LateRows
    late = LateRows(scratch_dir(spark, "t-late"))
    rows = lambda *secs: spark.createDataFrame([(s, None if s is None else T0 + dt.timedelta(seconds=s)) for s in secs], "s int, event_time timestamp")
    late(rows(0, None, 100), 0)
    late(rows(89, 90, 200, None), 1)
    late(rows(89, 90, 200, None), 1)
    late(rows(), 2)
    late(rows(189, 191), 3)
    assert sorted(r.s for r in late.rows(spark).collect()) == [89, 189]


def test_late_rows_fixture_one_file_per_batch(spark):
    """FIXTURES §6: files t=1-3 s; 1 h; 2 h + a row at 5 s; 2 h 1 s + a row
    at 5 s.  Late rows are filtered against the previous batch's watermark,
    so the first row at 5 s is accepted and the second dropped."""
    from geopulse.session import scratch_dir
    base = scratch_dir(spark, "t-late-fixture")
    schema = SCHEMA.replace("timestamp_ntz", "timestamp")
    files = [[1, 2, 3], [3600], [7200, 5], [7201, 5]]
    pid = 0
    for secs in files:
        rows = []
        for s in secs:
            rows.append((pid, "DRV_1", 28.61, 77.2, "on_trip", 10.0, 0, T0 + dt.timedelta(seconds=s)))
            pid += 1
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(base + "/landing")
    src = spark.readStream.schema(spark.read.parquet(base + "/landing").schema) \
        .option("maxFilesPerTrigger", 1).parquet(base + "/landing").withWatermark("event_time", "10 seconds")
    counts = src.groupBy(F.window("event_time", "30 seconds")).count()
    q = (counts.writeStream.format("parquet").outputMode("append")
         .option("path", base + "/out").option("checkpointLocation", base + "/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    import json
    dropped = sum(int(op.get("numRowsDroppedByWatermark", 0))
                  for p in q.recentProgress for op in json.loads(p.json).get("stateOperators", []))
    assert dropped == 1
    out = spark.read.parquet(base + "/out")
    first_window = out.filter(F.col("window.start") == F.lit(T0).cast("timestamp"))
    assert first_window.agg(F.sum("count")).first()[0] == 4  # 3 on time + the accepted late row


def test_failed_batch_is_rerun_without_duplicates(spark):
    """A micro-batch that fails after writing some of its output is re-run
    from the checkpoint on restart; batch-keyed overwrites leave no
    duplicate anomalies and no stale cache rows."""
    from geopulse.session import scratch_dir
    from geopulse.sinks.branch import CacheAndAnomalies
    from geopulse.streaming.replay import stream_source
    from geopulse.sources.events import to_stream_time

    base = scratch_dir(spark, "t-retry")
    p = to_stream_time(batch.pings(spark, SF))
    p.write.parquet(base + "/landing")
    state = {"failed": False}

    class FailOnce(CacheAndAnomalies):
        def __call__(self, df, batch_id):
            if not state["failed"]:
                # write part of the batch's output, then die
                E.anomalies(df).limit(3).write.mode("overwrite").parquet(self.anomaly_path(batch_id))
                state["failed"] = True
                raise RuntimeError("simulated executor loss")
            super().__call__(df, batch_id)

    def start(writer):
        src = stream_source(spark, base + "/landing", p.schema)
        return (E.enrich(src).writeStream.foreachBatch(writer)
                .option("checkpointLocation", base + "/ck").trigger(availableNow=True).start())

    q = start(FailOnce(base + "/side"))
    try:
        q.awaitTermination()
    except Exception:  # noqa: BLE001 - the simulated failure
        pass
    assert state["failed"]
    side = FailOnce(base + "/side")
    start(side).awaitTermination()
    e = E.enrich(batch.pings(spark, SF))
    assert side.all_anomalies(spark).count() == E.anomalies(e).count()
    assert side.store.read(spark).count() == e.select("driver_id").distinct().count()


def test_out_of_order_delivery_within_watermark(spark):
    """Pings around every chunk edge arrive out of order (4 s bands swapped,
    under half the 10 s delay): buffered release, state and windows give the
    same result as in-order delivery."""
    import duckdb

    import __spark_entry__ as entry
    from geopulse.streaming import queries as Q
    from geopulse.streaming.stateful import live_state_stream, previous_ping_stream, segments_stream
    from tests.test_oracle import _rows

    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM read_parquet('{sf}/events.parquet')")
    p = batch.pings(spark, sf)
    from geopulse.sources.events import to_stream_time
    from geopulse.streaming.replay import time_chunks
    bounds = time_chunks(to_stream_time(p), 4)
    us = F.unix_micros(F.col("event_time").cast("timestamp"))
    near_edge = F.lit(False)
    for x in bounds:
        near_edge = near_edge | ((us >= x - 4_000_000) & (us < x + 4_000_000))
    assert p.filter(near_edge).count() >= 5  # pings really are delivered out of order
    builds = {
        "stream_derived_speed": lambda s: Q.derived_speed_from_previous(previous_ping_stream(s)),
        "stream_trip_segments": segments_stream,
        "stream_zone_occupancy": lambda s: W.zone_occupancy(E.enrich(s)),
        "stream_live_state": lambda s: live_state_stream(E.enrich(s)),
    }
    flush = {"stream_live_state": None, "stream_trip_segments": "drivers"}
    for key, build in builds.items():
        run = run_replay(spark, p, build, "t-ooo", chunks=4, swap_us=4_000_000, flush=flush.get(key, "time"))
        got = to_ntz(read_output(spark, run))
        if key == "stream_live_state":
            got = Q.final_live_state(got)
        assert dropped_by_watermark(run) == 0, key
        assert _rows(got.toPandas()) == _rows(con.sql(entry.oracle_sql()[key]).df()), key


def test_flushed_replay_holds_no_marker_and_takes_empty_tables(spark):
    from geopulse.streaming.replay import END_STATUS
    from geopulse.streaming.stateful import segments_stream

    rows = [(1, "a", 1.0, 2.0, "on_trip", 3.0, 4, T0), (2, "a", 1.0, 2.0, None, 3.0, 4, T0 + dt.timedelta(seconds=5)),
            (3, None, 1.0, 2.0, "on_trip", 3.0, 4, T0)]
    p = spark.createDataFrame(rows, SCHEMA)
    got = to_ntz(read_output(spark, run_replay(spark, p, segments_stream, "t-flush", chunks=1, flush="drivers"))).collect()
    assert sorted((r.driver_id or "", r.status or "", r.pings) for r in got) == [("", "on_trip", 1), ("a", "", 1), ("a", "on_trip", 1)]
    assert all(r.status != END_STATUS for r in got)
    seen = read_output(spark, run_replay(spark, p, None, "t-flush", chunks=1, flush="time"))
    assert seen.count() == 3
    empty = run_replay(spark, p.limit(0), lambda s: W.zone_occupancy(E.enrich(s)), "t-flush", flush="time")
    assert read_output(spark, empty, W.zone_occupancy(E.enrich(p)).schema).count() == 0
    wired = run_replay(spark, p.where("driver_id is not null"), lambda s: W.zone_occupancy(E.enrich(s)), "t-flush", chunks=1,
                       flush="time", wire_format=True)
    assert read_output(spark, wired).agg(F.sum("ping_count")).first()[0] == 2
