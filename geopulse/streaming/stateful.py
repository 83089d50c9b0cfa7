"""Keyed stateful stream operators on ``transformWithStateInPandas``.

* ``LiveStateProcessor`` (S8/F5): latest ping per driver and its event-time
  expiry; emits ``LIVE`` on each update and ``EXPIRED`` when no ping
  came for the TTL.
* ``PreviousPingProcessor`` (F2) and ``SegmentProcessor`` (F3/F4): rows of a
  key arrive unordered within and across micro-batches, so they are buffered
  by time bucket and released in ``(event_time, ping_id)`` order once the
  watermark has passed the bucket; anything older than the watermark is dropped by
  Spark as late, so released order is final.
* ``SessionProcessor`` (W4): trip sessions with one state row each and their zones
  as map entries once they are many, so a session's row does not grow with its length.

A key is a shard, a fixed share of the drivers by hash: a call into Python, a state
access and a timer cost far more than a ping, so each is made for many drivers at once.
Input is read frame by frame and pings wait in pieces of bounded size: no step
holds a shard's whole batch or backlog in one frame.  What is known of each driver (its
live state, last ping, open run, open short sessions) is one packed value of the shard.
"""

from __future__ import annotations

import sys
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.exprs import DEG_TO_RAD, EARTH_RADIUS_KM, exact_speed, haversine_km
from ..operators.windows import duration_micros, on_trip_pings, session_columns
from ..schema import LIVE_TTL_SECS, SESSION_GAP


# The processors travel to the Python workers by value (their code, not a
# reference to this module), so executors and the driver-side state runner
# need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def require_rocksdb(df: DataFrame) -> None:
    """Prepare the session for ``transformWithStateInPandas``.

    It keeps several state variables per key (column families), which only
    the RocksDB state store supports; the provider is a runtime SQL setting,
    fixed per query by its checkpoint."""
    spark = df.sparkSession
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key, None) != ROCKSDB_PROVIDER:
        spark.conf.set(key, ROCKSDB_PROVIDER)


#: Shares that the drivers of a stream are dealt to; fixed in a query's checkpoint, as its partitions are.  Buffered
#: release pays for each shard and time bucket, the others for each shard and batch.
SHARDS, RELEASE_SHARDS = 256, 64


def _by_shard(df: DataFrame, shards: int):
    return df.withColumn("_shard", F.pmod(F.xxhash64("driver_id"), F.lit(shards))).groupBy("_shard")


def _drivers(key, pdf: pd.DataFrame) -> pd.Series:
    """The driver of every row; rows without that column are those of the driver that is the key."""
    return pdf["driver_id"] if "driver_id" in pdf else pd.Series(key[0], index=pdf.index, dtype="object")


def _micros(s: pd.Series) -> np.ndarray:
    return s.astype("datetime64[us]").astype("int64").to_numpy()


def _ts(us) -> pd.Series:
    return pd.Series(np.asarray(us, dtype="int64")).astype("datetime64[us]")


def _order_ids(ids: pd.Series) -> np.ndarray:
    """Ping ids to order by, missing ones first."""
    return ids.fillna(-2**63).to_numpy("int64")


def _pack(rows: Iterable[tuple], schema: pa.Schema) -> bytes:
    columns = list(zip(*rows)) or [()] * len(schema)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema).serialize().to_pybytes()


def _unpack(data, schema: pa.Schema) -> Iterator[tuple]:
    batch = pa.ipc.read_record_batch(pa.py_buffer(bytes(data)), schema)
    return zip(*(c.to_pylist() for c in batch.columns))


# ---------------------------------------------------------------------------
# Live state with expiry
# ---------------------------------------------------------------------------

#: The live state of a shard's drivers, packed, and the time of its timer.
PACKED_STATE = "timer long, data binary"
_LIVE_SCHEMA = pa.schema([("driver_id", pa.string()), ("ping_id", pa.int64()), ("t", pa.int64()), ("latitude", pa.float64()),
                          ("longitude", pa.float64()), ("h3_cell", pa.string()), ("status", pa.string()), ("speed_kmh", pa.float64())])

LIVE_OUTPUT_SCHEMA = T.StructType([
    T.StructField("driver_id", T.StringType()), T.StructField("ping_id", T.LongType()),
    T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType()),
    T.StructField("h3_cell", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("speed_kmh", T.DoubleType()), T.StructField("event_time", T.TimestampType()),
    T.StructField("state", T.StringType()),
])


class LiveStateProcessor(StatefulProcessor):
    """Latest ping per driver; it expires at that ping + TTL.

    A shard has one timer, at the first expiry of its drivers; one that finds its driver
    moved on does nothing but set the next."""

    def __init__(self, ttl_secs: int = LIVE_TTL_SECS):
        self.ttl_ms = ttl_secs * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.live = handle.getValueState("live", PACKED_STATE)

    def _load(self) -> tuple[int | None, dict]:
        timer, data = self.live.get() or (None, None)
        return timer, {} if data is None else {r[0]: r for r in _unpack(data, _LIVE_SCHEMA)}

    def _expires(self, row: tuple) -> int:
        return row[2] // 1000 + self.ttl_ms

    def _save(self, timer: int | None, live: dict) -> None:
        if not live:
            self.live.clear()
            return
        first = min(map(self._expires, live.values()))
        if timer is None or first < timer:
            self.handle.registerTimer(first)
            timer = first
        self.live.update((timer, _pack(live.values(), _LIVE_SCHEMA)))

    def _rows(self, rows: list[tuple], state: str) -> Iterator[pd.DataFrame]:
        if rows:
            out = pd.DataFrame(rows, columns=_LIVE_SCHEMA.names)
            yield out.drop(columns="t").assign(event_time=_ts(out["t"]), state=state)[LIVE_OUTPUT_SCHEMA.names]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        timer, live = self._load()
        moved = {}
        for pdf in rows:
            pdf = pdf.assign(t=_micros(pdf["event_time"]), ping_id=_order_ids(pdf["ping_id"]), driver_id=_drivers(key, pdf))
            last = pdf.iloc[np.lexsort((pdf["ping_id"], pdf["t"]))].drop_duplicates("driver_id", keep="last")
            for row in zip(*(last[c].tolist() for c in _LIVE_SCHEMA.names)):
                old = live.get(row[0])
                if old is None or (row[2], row[1]) > (old[2], old[1]):
                    live[row[0]] = moved[row[0]] = row
        if moved:
            self._save(timer, live)
        yield from self._rows(list(moved.values()), "LIVE")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        timer, live = self._load()
        now = timerValues.getCurrentWatermarkInMs()
        if timer is None or timer > now:  # an earlier timer's
            return
        over = [r for r in live.values() if self._expires(r) <= now]
        for r in over:
            del live[r[0]]
        self._save(None, live)
        yield from self._rows(over, "EXPIRED")

    def close(self) -> None:
        pass


def live_state_stream(enriched: DataFrame, ttl_secs: int = LIVE_TTL_SECS, shards: int = SHARDS) -> DataFrame:
    cols = ["driver_id", "ping_id", "latitude", "longitude", "h3_cell", "status",
            "speed_kmh", "event_time"]
    require_rocksdb(enriched)
    return (_by_shard(enriched.select(*cols), shards)
            .transformWithStateInPandas(LiveStateProcessor(ttl_secs), LIVE_OUTPUT_SCHEMA,
                                        "Append", "EventTime"))


# ---------------------------------------------------------------------------
# Ordered release of a driver's pings
# ---------------------------------------------------------------------------

#: Width of a pending bucket, rows of a stored part and of a released frame, and rows gathered before they are stored.
RELEASE_BUCKET_US, RELEASE_ROWS = 10_000_000, 4096
GATHERED_ROWS = 64 * RELEASE_ROWS


_STORED_SCHEMA = pa.schema([("driver_id", pa.string()), ("ping_id", pa.int64()), ("t", pa.int64()), ("latitude", pa.float64()),
                            ("longitude", pa.float64()), ("status", pa.string())])


def _in_order(pings: pd.DataFrame) -> pd.DataFrame:
    return pings.iloc[np.lexsort((_order_ids(pings["ping_id"]), pings["t"]))]


class _OrderedRelease(StatefulProcessor):
    """Buffers a shard's pings and releases them in order.

    Pending pings are kept by time bucket, in sorted parts of at most ``RELEASE_ROWS``
    rows.  Each bucket has a timer at its end: when the watermark gets there, no ping of
    the bucket can come any more, and its parts are merged and released in frames.  The first
    timer that fires releases every bucket that the watermark has passed, oldest first."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.parts = handle.getMapState("parts", "bucket long", "n long")
        self.rows = handle.getMapState("rows", "bucket long, part long", "data binary")
        self.setup_state(handle)

    def setup_state(self, handle) -> None:  # pragma: no cover - overridden
        raise NotImplementedError

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        gathered, n = [], 0
        for pdf in rows:
            gathered.append(pd.DataFrame({
                "driver_id": _drivers(key, pdf), "ping_id": pdf["ping_id"], "t": _micros(pdf["event_time"]),
                "latitude": pdf["latitude"].astype("float64"), "longitude": pdf["longitude"].astype("float64"), "status": pdf["status"]}))
            n += len(pdf)
            if n >= GATHERED_ROWS:
                self._store(gathered)
                gathered, n = [], 0
        if n:
            self._store(gathered)
        return iter([])

    def _store(self, frames: list[pd.DataFrame]) -> None:
        new = _in_order(pd.concat(frames, ignore_index=True))
        bucket = (new["t"] // RELEASE_BUCKET_US).to_numpy()
        data = pa.RecordBatch.from_pandas(new, schema=_STORED_SCHEMA, preserve_index=False)
        edges = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]]).tolist()
        for i, j in zip(edges[:-1], edges[1:]):
            b = int(bucket[i])
            n = (self.parts.getValue((b,)) or (0,))[0]
            if not n:
                self.handle.registerTimer((b + 1) * RELEASE_BUCKET_US // 1000)
            for at in range(i, j, RELEASE_ROWS):
                self.rows.updateValue((b, n), (data.slice(at, min(RELEASE_ROWS, j - at)).serialize().to_pybytes(),))
                n += 1
            self.parts.updateValue((b,), (n,))

    def _taken(self, bucket: int, n: int) -> pd.DataFrame:
        """The bucket's pings in order; its state goes."""
        parts = []
        for i in range(n):
            data = bytes(self.rows.getValue((bucket, i))[0])
            parts.append(pa.ipc.read_record_batch(pa.py_buffer(data), _STORED_SCHEMA))
            self.rows.removeKey((bucket, i))
        self.parts.removeKey((bucket,))
        rows = pa.Table.from_batches(parts).to_pandas()
        return rows if n == 1 else _in_order(rows)

    def _frames(self, buckets: list[tuple[int, int]]) -> Iterator[pd.DataFrame]:
        """The buckets' pings in order, in frames of at most ``RELEASE_ROWS``."""
        small, size = [], 0
        for bucket, n in buckets:
            rows = self._taken(bucket, n)
            if size + len(rows) > RELEASE_ROWS:
                if small:
                    yield pd.concat(small, ignore_index=True)
                small, size = [], 0
            if len(rows) > RELEASE_ROWS:
                for at in range(0, len(rows), RELEASE_ROWS):
                    yield rows.iloc[at:at + RELEASE_ROWS].reset_index(drop=True)
            else:
                small.append(rows)
                size += len(rows)
        if small:
            yield pd.concat(small, ignore_index=True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs()
        if not self.parts.containsKey((end * 1000 // RELEASE_BUCKET_US - 1,)):  # released by an earlier timer
            return
        if timerValues is not None:
            end = max(end, timerValues.getCurrentWatermarkInMs())
        passed = sorted((b, n) for (b,), (n,) in list(self.parts.iterator()) if (b + 1) * RELEASE_BUCKET_US // 1000 <= end)
        self.begin()
        for ready in self._frames(passed):
            out = self.release(key[0], ready)
            if out is not None and len(out):
                yield out
        self.end()

    def begin(self) -> None:
        """Before the frames of a firing."""

    def end(self) -> None:
        """After them."""

    def release(self, shard, ready: pd.DataFrame) -> pd.DataFrame | None:  # pragma: no cover
        raise NotImplementedError

    def close(self) -> None:
        pass


class _DriverRelease(_OrderedRelease):
    """Ordered release that goes on, for every driver, from a row kept of its earlier pings."""

    kept: pa.Schema  # of that row, the driver first

    def setup_state(self, handle) -> None:
        self.state = handle.getValueState("last", "data binary")

    def begin(self) -> None:
        held = self.state.get()
        self.last = {r[0]: r for r in _unpack(held[0], self.kept)} if held else {}

    def end(self) -> None:
        self.state.update((_pack(self.last.values(), self.kept),))

    def _after_last(self, ready: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
        """The pings driver by driver, behind the row kept of each; whether a row is its driver's
        first, and its place in ``ready`` (below 0: a kept one)."""
        known = [self.last[d] for d in ready["driver_id"].unique() if d in self.last]
        before = pa.Table.from_pylist([dict(zip(self.kept.names, r)) for r in known], schema=self.kept).to_pandas()
        own = ready[self.kept.names]
        rows = pd.concat([before, own], ignore_index=True) if known else own
        code = pd.factorize(rows["driver_id"], use_na_sentinel=False)[0]
        order = np.argsort(code, kind="stable")
        first = np.diff(code[order], prepend=-1) != 0
        return rows.iloc[order].reset_index(drop=True), first, order - len(known)

    def _keep(self, rows: pd.DataFrame) -> None:
        for r in zip(*(rows[c].tolist() for c in self.kept.names)):
            self.last[r[0]] = r


PREV_OUTPUT_SCHEMA = T.StructType([
    T.StructField("ping_id", T.LongType()), T.StructField("driver_id", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType()),
    T.StructField("prev_latitude", T.DoubleType()), T.StructField("prev_longitude", T.DoubleType()),
    T.StructField("prev_t", T.LongType()), T.StructField("t", T.LongType()),
])


class PreviousPingProcessor(_DriverRelease):
    """Emits each ping with its predecessor's position and time."""

    kept = pa.schema([("driver_id", pa.string()), ("t", pa.int64()), ("latitude", pa.float64()), ("longitude", pa.float64())])

    def release(self, shard, ready):
        rows, first, at = self._after_last(ready)
        out = pd.DataFrame({
            "driver_id": rows["driver_id"],
            "event_time": _ts(rows["t"]),
            "latitude": rows["latitude"], "longitude": rows["longitude"],
            "prev_latitude": rows["latitude"].shift().mask(first),
            "prev_longitude": rows["longitude"].shift().mask(first),
            "prev_t": rows["t"].astype("Int64").shift().mask(first), "t": rows["t"]})
        self._keep(rows[np.append(first[1:], True)])
        return out[at >= 0].assign(ping_id=ready["ping_id"].to_numpy()[at[at >= 0]])


def previous_ping_stream(pings: DataFrame, shards: int = RELEASE_SHARDS) -> DataFrame:
    cols = ["driver_id", "ping_id", "latitude", "longitude", "status", "event_time"]
    require_rocksdb(pings)
    return (_by_shard(pings.select(*cols), shards)
            .transformWithStateInPandas(PreviousPingProcessor(), PREV_OUTPUT_SCHEMA,
                                        "Append", "EventTime"))


def _haversine_np(lat1, lon1, lat2, lon2) -> np.ndarray:
    p1, p2 = np.asarray(lat1) * DEG_TO_RAD, np.asarray(lat2) * DEG_TO_RAD
    l1, l2 = np.asarray(lon1) * DEG_TO_RAD, np.asarray(lon2) * DEG_TO_RAD
    a = np.sin((p2 - p1) / 2.0) ** 2 + np.cos(p1) * np.cos(p2) * np.sin((l2 - l1) / 2.0) ** 2
    return EARTH_RADIUS_KM * (2.0 * np.arcsin(np.sqrt(np.minimum(a, 1.0))))


SEG_OUTPUT_SCHEMA = T.StructType([
    T.StructField("driver_id", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("segment_start", T.TimestampType()), T.StructField("segment_end", T.TimestampType()),
    T.StructField("pings", T.LongType()), T.StructField("dist_micro", T.LongType()),
    T.StructField("t0", T.LongType()), T.StructField("t1", T.LongType()),
])


class SegmentProcessor(_DriverRelease):
    """Status runs; a run is emitted when the next one starts."""

    #: The open run: its last ping, its start, pings and length.
    kept = pa.schema([("driver_id", pa.string()), ("t", pa.int64()), ("latitude", pa.float64()), ("longitude", pa.float64()),
                      ("status", pa.string()), ("t0", pa.int64()), ("pings", pa.int64()), ("dist", pa.int64())])

    def release(self, shard, ready):
        """Vectorised run detection over the released rows, continuing the
        open runs kept in state; every run but a driver's last is closed."""
        rows, first, _ = self._after_last(ready.assign(t0=ready["t"], pings=1, dist=0))
        status, no_status = rows["status"].to_numpy(dtype=object), rows["status"].isna().to_numpy()
        same = (status == np.roll(status, 1)) | (no_status & np.roll(no_status, 1))
        changed = first | ~same
        lat, lon = rows["latitude"].to_numpy("float64"), rows["longitude"].to_numpy("float64")
        km = _haversine_np(np.roll(lat, 1), np.roll(lon, 1), lat, lon)
        # a leg with a missing end has no length, as in the batch form
        legs = np.rint(np.where(changed | ~np.isfinite(km), 0.0, km) * 1e6).astype("int64")
        starts = np.flatnonzero(changed)
        ends = np.append(starts[1:], len(rows)) - 1
        runs = rows.iloc[ends].assign(
            t0=rows["t0"].to_numpy()[starts], pings=np.add.reduceat(rows["pings"].to_numpy("int64"), starts),
            dist=np.add.reduceat(rows["dist"].to_numpy("int64") + legs, starts))
        last = np.append(first[starts[1:]], True)
        self._keep(runs[last])
        closed = runs[~last].reset_index(drop=True)
        return pd.DataFrame({
            "driver_id": closed["driver_id"], "status": closed["status"],
            "segment_start": _ts(closed["t0"]), "segment_end": _ts(closed["t"]),
            "pings": closed["pings"], "dist_micro": closed["dist"], "t0": closed["t0"], "t1": closed["t"]})


def segments_stream(pings: DataFrame, shards: int = RELEASE_SHARDS) -> DataFrame:
    cols = ["driver_id", "ping_id", "latitude", "longitude", "status", "event_time"]
    require_rocksdb(pings)
    raw = (_by_shard(pings.select(*cols), shards)
           .transformWithStateInPandas(SegmentProcessor(), SEG_OUTPUT_SCHEMA, "Append", "EventTime"))
    return raw.select(
        "driver_id", "status", "segment_start", "segment_end", "pings",
        (F.col("dist_micro") / F.lit(1e6)).alias("distance_km"),
        ((F.col("t1") - F.col("t0")) / F.lit(1e6)).alias("duration_secs"))


def derived_speed_from_previous(prev: DataFrame) -> DataFrame:
    """Same column expressions as the batch ``derived_speed``."""
    km = haversine_km("prev_latitude", "prev_longitude", "latitude", "longitude")
    secs = (F.col("t") - F.col("prev_t")) / F.lit(1e6)
    speed = F.when(F.col("prev_t").isNull(), F.lit(None).cast("double")) \
        .when(secs > 0, F.round(km / secs * 3600.0, 2)).otherwise(F.lit(0.0))
    return prev.select("ping_id", "driver_id", "event_time",
                       F.round(km, 6).alias("distance_km"),
                       secs.alias("seconds_since_prev"), speed.alias("derived_speed_kmh"))


# ---------------------------------------------------------------------------
# Trip sessions
# ---------------------------------------------------------------------------

#: An open session: its first and last time, counts, the speed total in 10^-9 km/h (as text: it can
#: outgrow 64 bits), the bounding box, the longest duration and the number of zones.
_SESSION_STATE = ("first long, last long, n long, total string, ns long, maxlat double, maxlon double, "
                  "minlat double, minlon double, maxdur int, cells long, driver string")
_SESSION_SCHEMA = pa.schema([
    ("driver_id", pa.string()), ("zones", pa.list_(pa.string())), ("first", pa.int64()), ("last", pa.int64()), ("n", pa.int64()),
    ("total", pa.string()), ("ns", pa.int64()), ("maxlat", pa.float64()), ("maxlon", pa.float64()), ("minlat", pa.float64()),
    ("minlon", pa.float64()), ("maxdur", pa.int32()), ("cells", pa.int64())])
#: Zones up to which an open session is packed with the others of its shard.
PACKED_ZONES = 32
SESSION_OUTPUT_SCHEMA = T.StructType([
    T.StructField("driver_id", T.StringType()), T.StructField("tmin", T.TimestampType()), T.StructField("tmax", T.TimestampType()),
    T.StructField("n", T.LongType()), T.StructField("total", T.StringType()), T.StructField("ns", T.LongType()),
    T.StructField("maxlat", T.DoubleType()), T.StructField("maxlon", T.DoubleType()),
    T.StructField("minlat", T.DoubleType()), T.StructField("minlon", T.DoubleType()),
    T.StructField("maxdur", T.IntegerType()), T.StructField("cells", T.LongType()),
])
_NANO = 10**9


def _either(pick, *values):
    """``pick`` of the values that are there."""
    there = [v for v in values if v is not None and v == v]
    return pick(there) if there else None


@dataclass
class _Session:
    """An open session: its driver, the values of its state row (the total as a number), and its zones;
    one whose zones are map entries has their id instead."""

    driver: str | None
    row: tuple
    zones: set = field(default_factory=set)
    id: int | None = None


class SessionProcessor(StatefulProcessor):
    """Sessions of the drivers' pings: a ping within the gap of a driver's session joins it, and
    sessions that a ping brings together become one.

    Open sessions of few zones are packed in one value of the shard.  One with more is a map
    entry, its zones are map entries of their own.  A session closes when the watermark reaches
    its last ping plus the gap; the shard has one timer, where its first session may close, and
    one that finds its session extended does nothing but set the next."""

    def __init__(self, gap_us: int):
        self.gap_us = gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.packed = handle.getValueState("packed", PACKED_STATE)
        self.sessions = handle.getMapState("sessions", "id long", _SESSION_STATE)
        self.zones = handle.getMapState("zones", "id long, cell string", "seen boolean")

    def _closes(self, s: _Session) -> int:
        """First millisecond at which a session is over."""
        return -(-(s.row[1] + self.gap_us) // 1000)

    def _load(self) -> tuple[int | None, dict[str | None, list[_Session]]]:
        """The shard's timer and open sessions, each driver's in order."""
        timer, data = self.packed.get() or (None, None)
        found = defaultdict(list)
        for driver, zones, *row in _unpack(data, _SESSION_SCHEMA) if data is not None else ():
            found[driver].append(_Session(driver, (*row[:3], int(row[3]), *row[4:]), set(zones)))
        for (sid,), row in list(self.sessions.iterator()):
            found[row[11]].append(_Session(row[11], (*row[:3], int(row[3]), *row[4:11]), id=sid))
        for own in found.values():
            own.sort(key=lambda s: s.row[0])
        self.next_id = 1 + max((s.id for own in found.values() for s in own if s.id is not None), default=-1)
        return timer, found

    def _save(self, timer: int | None, found: dict[str | None, list[_Session]]) -> None:
        opened = [s for own in found.values() for s in own]
        if not opened:
            self.packed.clear()
            return
        first = min(map(self._closes, opened))
        if timer is None or first < timer:
            self.handle.registerTimer(first)
            timer = first
        rows = [(s.driver, list(s.zones), *s.row[:3], str(s.row[3]), *s.row[4:]) for s in opened if s.id is None]
        self.packed.update((timer, _pack(rows, _SESSION_SCHEMA)))

    def _joined(self, a: tuple, b: tuple) -> tuple:
        return (min(a[0], b[0]), max(a[1], b[1]), a[2] + b[2], a[3] + b[3], a[4] + b[4],
                _either(max, a[5], b[5]), _either(max, a[6], b[6]), _either(min, a[7], b[7]), _either(min, a[8], b[8]),
                _either(max, a[9], b[9]), 0)

    def _drop(self, s: _Session) -> set[str]:
        """The session's map entries go; their zones."""
        cells = {k[1] for k, _ in list(self.zones.iterator()) if k[0] == s.id}
        for cell in cells:
            self.zones.removeKey((s.id, cell))
        self.sessions.removeKey((s.id,))
        return cells

    def _add(self, own: list[_Session], piece: _Session) -> None:
        """A run of pings without a gap in it joins those of its driver's sessions that it touches."""
        lo = bisect_left(own, piece.row[0] - self.gap_us, key=lambda s: s.row[1])
        hi = bisect_right(own, piece.row[1] + self.gap_us, key=lambda s: s.row[0])
        row, zones = piece.row, piece.zones
        listed = sorted((s for s in own[lo:hi] if s.id is not None), key=lambda s: -s.row[10])
        for s in own[lo:hi]:
            row, zones = self._joined(row, s.row), zones | s.zones
        for s in listed[1:]:  # the smaller sessions' zones move
            zones |= self._drop(s)
        if listed or len(zones) > PACKED_ZONES:
            sid, cells = (listed[0].id, listed[0].row[10]) if listed else (self.next_id, 0)
            self.next_id = max(self.next_id, sid + 1)
            for cell in zones:
                if not self.zones.containsKey((sid, cell)):
                    self.zones.updateValue((sid, cell), (True,))
                    cells += 1
            whole = _Session(piece.driver, (*row[:10], cells), id=sid)
            self.sessions.updateValue((sid,), (*row[:3], str(row[3]), *row[4:10], cells, piece.driver))
        else:
            whole = _Session(piece.driver, (*row[:10], len(zones)), zones)
        own[lo:hi] = [whole]

    def _pieces(self, key, pdf: pd.DataFrame) -> Iterator[_Session]:
        """The frame's pings as runs of a driver's without a gap."""
        code, drivers = pd.factorize(_drivers(key, pdf), use_na_sentinel=False)
        t = _micros(pdf["event_time"])
        order = np.lexsort((t, code))
        t, code, pdf = t[order], code[order], pdf.iloc[order]
        starts = np.flatnonzero((np.diff(code, prepend=-1) != 0) | (np.diff(t, prepend=t[0]) > self.gap_us))
        ends = np.append(starts[1:], len(t))
        measured = pdf["nano_speed"].notna().to_numpy()
        nano = pdf["nano_speed"].fillna(0).to_numpy("int64")
        high, low = (np.add.reduceat(x, starts).tolist() for x in (nano >> 32, nano & (2**32 - 1)))
        most, least = ({c: pick.reduceat(pdf[c].to_numpy("float64"), starts).tolist() for c in names} for pick, names in (
            (np.fmax, ("latitude", "longitude", "trip_duration_secs")), (np.fmin, ("latitude", "longitude"))))
        cells = pdf["h3_cell"].tolist()
        values = zip(code[starts].tolist(), starts.tolist(), ends.tolist(), t[starts].tolist(), t[ends - 1].tolist(), high, low,
                     np.add.reduceat(measured.astype("int64"), starts).tolist(), most["latitude"], most["longitude"],
                     least["latitude"], least["longitude"], most["trip_duration_secs"])
        for c, i, j, first, last, hi, lo, ns, *box, longest in values:
            zones = {x for x in cells[i:j] if isinstance(x, str)}
            box = [None if v != v else v for v in box]
            driver = drivers[c] if isinstance(drivers[c], str) else None
            yield _Session(driver, (first, last, j - i, (hi << 32) + lo, ns, *box, None if longest != longest else int(longest), len(zones)), zones)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        timer, found = self._load()
        for pdf in rows:
            for piece in self._pieces(key, pdf):
                self._add(found[piece.driver], piece)
        self._save(timer, found)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        timer, found = self._load()
        now = timerValues.getCurrentWatermarkInMs()
        if timer is None or timer > now:  # an earlier timer's
            return
        over = [s for own in found.values() for s in own if self._closes(s) <= now]
        self._save(None, {d: [s for s in own if self._closes(s) > now] for d, own in found.items()})
        for s in over:
            if s.id is not None:
                self._drop(s)
        for at in range(0, len(over), RELEASE_ROWS):
            some = over[at:at + RELEASE_ROWS]
            first, last, n, total, ns, maxlat, maxlon, minlat, minlon, maxdur, cells = zip(*(s.row for s in some))
            signed = [("-" if x < 0 else "", divmod(abs(x), _NANO)) for x in total]
            yield pd.DataFrame({
                "driver_id": pd.Series([s.driver for s in some], dtype="object"), "tmin": _ts(first), "tmax": _ts(last), "n": n,
                "total": [f"{sign}{whole}.{rest:09d}" for sign, (whole, rest) in signed], "ns": ns,
                "maxlat": pd.Series(maxlat, dtype="float64"), "maxlon": pd.Series(maxlon, dtype="float64"),
                "minlat": pd.Series(minlat, dtype="float64"), "minlon": pd.Series(minlon, dtype="float64"),
                "maxdur": pd.array(maxdur, "Int32"), "cells": cells})

    def close(self) -> None:
        pass


def trip_sessions_stream(enriched: DataFrame, gap: str = SESSION_GAP, shards: int = SHARDS) -> DataFrame:
    """Streaming form of ``trip_sessions``: one row for each session, once it is over."""
    gap_us = duration_micros(gap)
    nano = (exact_speed("speed_kmh") * F.lit(_NANO)).cast("bigint")
    require_rocksdb(enriched)
    pings = on_trip_pings(enriched).select("driver_id", "event_time", "latitude", "longitude", "h3_cell", "trip_duration_secs",
                                           nano.alias("nano_speed"))
    closed = (_by_shard(pings, shards)
              .transformWithStateInPandas(SessionProcessor(gap_us), SESSION_OUTPUT_SCHEMA, "Append", "EventTime"))
    return session_columns(closed.withColumn("s", F.col("total").cast("decimal(32,9)")), gap_us)
