"""JSON wire format: decode with quarantine (S4, T1, T2) and encode.

Decoding never raises: a message that is not JSON, has a field of a wrong type,
or lacks a usable event time, driver, position or speed, is routed to the
quarantine relation with a reason instead of being silently nulled or dropped.
good + quarantined = input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import finite_speed, parse_event_time, usable_position
from ..schema import PING_COLUMNS, WIRE_SCHEMA

CORRUPT_COL = "_corrupt_record"
REASON_NOT_JSON = "not_json"
REASON_BAD_FIELD = "bad_field"
REASON_NO_TIME = "no_event_time"
REASON_NO_DRIVER = "no_driver"
REASON_BAD_POSITION = "bad_position"
REASON_BAD_SPEED = "bad_speed"

#: Bodies of JSON messages that can't be used, each with its reason.
UNUSABLE_MESSAGES = [
    ('"driver_id": "D", "latitude": 1, "longitude": 1, "timestamp": "999999999999999999"', REASON_NO_TIME),
    ('"latitude": 1, "longitude": 1, "timestamp": "1000"', REASON_NO_DRIVER),
    ('"driver_id": "D", "latitude": 1e300, "longitude": 1, "timestamp": "1000"', REASON_BAD_POSITION),
    ('"driver_id": "D", "longitude": 1, "timestamp": "1000"', REASON_BAD_POSITION),
    ('"driver_id": "D", "latitude": 1, "longitude": 1, "timestamp": "1000", "speed_kmh": 1e999', REASON_BAD_SPEED),
    ('"driver_id": "D", "latitude": "x", "longitude": 1, "timestamp": "1000"', REASON_BAD_FIELD),
]

_DECODE_SCHEMA = T.StructType(WIRE_SCHEMA.fields + [T.StructField(CORRUPT_COL, T.StringType())])


def _parsed(messages: DataFrame, value_col: str) -> DataFrame:
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL}
    return messages.withColumn("_m", F.from_json(F.col(value_col).cast("string"), _DECODE_SCHEMA, opts))


def decode_all(messages: DataFrame, value_col: str = "value", fallback_id: str | None = None) -> DataFrame:
    """One row for each raw message: the canonical ping columns, ``raw`` and ``reason``.

    A usable message has a ping and no reason, any other one its text and the reason.
    The duration is taken from either spelling, the time from any of the three
    encodings.

    Producers need not send ``ping_id`` (the tie-break between pings of a
    driver with equal event time).  When it is absent it comes from
    ``fallback_id`` (e.g. the source offset) or else from a 64-bit hash of the
    message text, deterministic across replays.
    """
    p = _parsed(messages, value_col)
    m = F.col("_m")
    raw = F.col(value_col).cast("string")
    broken = m.isNull() | m[CORRUPT_COL].isNotNull()
    speed = m["speed_kmh"]
    p = p.withColumn("_et", parse_event_time(m["ts_str"], m["timestamp"])).withColumn(
        "_reason", F.when(broken & F.try_parse_json(raw).isNull(), REASON_NOT_JSON)
        .when(broken, REASON_BAD_FIELD)
        .when(F.col("_et").isNull(), REASON_NO_TIME)
        .when(F.coalesce(m["driver_id"], F.lit("")) == "", REASON_NO_DRIVER)
        .when(~usable_position(m["latitude"], m["longitude"]), REASON_BAD_POSITION)
        .when(speed.isNotNull() & finite_speed(speed).isNull(), REASON_BAD_SPEED))
    fallback = F.col(fallback_id) if fallback_id else F.xxhash64(raw)
    values = {"ping_id": F.coalesce(m["ping_id"], fallback), "event_time": F.col("_et"),
              "trip_duration_secs": F.coalesce(m["trip_duration_secs"], m["trip_duration_sec"]),
              "ts_str": F.coalesce(m["ts_str"], m["timestamp"])}
    good = F.col("_reason").isNull()
    return p.select(*(F.when(good, values[c] if c in values else m[c]).alias(c) for c in PING_COLUMNS),
                    F.when(~good, raw).alias("raw"), F.col("_reason").alias("reason"))


def decode_with_quarantine(messages: DataFrame, value_col: str = "value",
                           fallback_id: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Split raw messages into (pings, quarantine): the canonical columns, and ``raw`` with ``reason``."""
    rows = decode_all(messages, value_col, fallback_id)
    good = rows.filter(F.col("reason").isNull()).select(*PING_COLUMNS)
    return good, rows.filter(F.col("reason").isNotNull()).select("raw", "reason")


def decode(messages: DataFrame, value_col: str = "value", fallback_id: str | None = None) -> DataFrame:
    return decode_with_quarantine(messages, value_col, fallback_id)[0]


def quarantine(messages: DataFrame, value_col: str = "value") -> DataFrame:
    return decode_with_quarantine(messages, value_col)[1]


ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def encode(pings: DataFrame, time_encoding: str = "iso") -> DataFrame:
    """Keyed messages ``(key, value)`` as the producer sends them.

    ``time_encoding``: ``iso`` → ISO string in ``timestamp`` (the simulator),
    ``ts_str`` → ISO string in ``ts_str`` (script 1), ``millis`` → epoch
    milliseconds in ``timestamp`` (script 2).  Coordinates keep 6 digits and
    speed 2, as in the payload.
    """
    t = F.col("event_time").cast("timestamp")
    iso = F.date_format(t, ISO_MICROS)
    fields = [F.col("ping_id"), F.col("driver_id"),
              F.round("latitude", 6).alias("latitude"),
              F.round("longitude", 6).alias("longitude"),
              F.col("status"), F.round("speed_kmh", 2).alias("speed_kmh")]
    if time_encoding == "iso":
        fields.append(iso.alias("timestamp"))
    elif time_encoding == "ts_str":
        fields.append(iso.alias("ts_str"))
    elif time_encoding == "millis":
        fields.append(F.unix_millis(t).alias("timestamp"))
    else:
        raise ValueError(f"unknown time encoding {time_encoding!r}")
    fields.append(F.col("trip_duration_secs"))
    return pings.select(F.col("driver_id").cast("string").alias("key"),
                        F.to_json(F.struct(*fields)).alias("value"))


def encode_mixed(pings: DataFrame) -> DataFrame:
    """Messages whose time encoding rotates with ``ping_id`` (0 iso, 1
    ts_str, 2 millis) — exercises every decoder branch on real rows.
    ``event_time`` is kept beside ``key``/``value`` for time-ordered landing."""
    t = F.col("event_time").cast("timestamp")
    iso = F.date_format(t, ISO_MICROS)
    k = F.pmod(F.col("ping_id"), F.lit(3))
    fields = [F.col("ping_id"), F.col("driver_id"),
              F.col("latitude"), F.col("longitude"), F.col("status"), F.col("speed_kmh"),
              F.when(k == 1, iso).alias("ts_str"),
              F.when(k == 0, iso).when(k == 2, F.unix_millis(t).cast("string")).alias("timestamp"),
              F.col("trip_duration_secs"), *(F.col(c) for c in pings.columns if c == "trip_distance_km")]
    return pings.select(F.col("driver_id").alias("key"), F.to_json(F.struct(*fields)).alias("value"),
                        F.col("event_time"))


def to_canonical(decoded: DataFrame) -> DataFrame:
    return decoded.select(*PING_COLUMNS)
