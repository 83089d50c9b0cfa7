"""Column expressions for the ping domain.

Every function here returns a ``Column`` built from Spark SQL built-ins, so it
is evaluated inside whole-stage codegen with no Python worker.  NULL input
gives NULL output (the reference's per-row functions raised on NULL).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import (
    ANOMALY_IMPOSSIBLE, ANOMALY_NEGATIVE, ANOMALY_NORMAL, HEX_RESOLUTION,
    IMPOSSIBLE_SPEED_KMH, MEDIUM_TRIP_SECS, SHORT_TRIP_SECS, STATUS_AVAILABLE,
)

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --------------------------------------------------------------------------
# Rules
# --------------------------------------------------------------------------

def anomaly_type(speed: ColumnOrName = "speed_kmh", status: ColumnOrName = "status") -> Column:
    """``NEGATIVE_SPEED`` below 0, ``IMPOSSIBLE_SPEED`` above 120 km/h while
    ``available``, otherwise ``NORMAL``; NULL speed gives NULL.

    NaN is tested explicitly: Spark orders NaN above every number, so
    ``NaN > 120`` would be true, unlike the reference's Python comparison.
    """
    s, st = _c(speed), _c(status)
    return (F.when(s.isNull(), F.lit(None).cast("string"))
            .when(s < 0, F.lit(ANOMALY_NEGATIVE))
            .when((s > IMPOSSIBLE_SPEED_KMH) & ~F.isnan(s) & (st == STATUS_AVAILABLE),
                  F.lit(ANOMALY_IMPOSSIBLE))
            .otherwise(F.lit(ANOMALY_NORMAL)))


def trip_category(duration_secs: ColumnOrName = "trip_duration_secs") -> Column:
    """0 for no trip, 1 below 5 min (negatives included), 2 below 15 min, else 3."""
    d = _c(duration_secs)
    return (F.when(d.isNull(), F.lit(None))
            .when(d == 0, F.lit(0))
            .when(d < SHORT_TRIP_SECS, F.lit(1))
            .when(d < MEDIUM_TRIP_SECS, F.lit(2))
            .otherwise(F.lit(3))).cast("bigint")


# --------------------------------------------------------------------------
# Geometry
# --------------------------------------------------------------------------

EARTH_RADIUS_KM = 6371.0
DEG_TO_RAD = math.pi / 180.0


def haversine_km(lat1: ColumnOrName, lon1: ColumnOrName,
                 lat2: ColumnOrName, lon2: ColumnOrName) -> Column:
    """Great-circle distance in km, R = 6371; NULL if a coordinate is.  The root argument is
    clamped to 1 so rounding noise can never push ``asin`` out of its domain."""
    p1, p2 = _c(lat1) * DEG_TO_RAD, _c(lat2) * DEG_TO_RAD
    l1, l2 = _c(lon1) * DEG_TO_RAD, _c(lon2) * DEG_TO_RAD
    a = (F.pow(F.sin((p2 - p1) / 2.0), 2.0)
         + F.cos(p1) * F.cos(p2) * F.pow(F.sin((l2 - l1) / 2.0), 2.0))
    return F.lit(EARTH_RADIUS_KM) * (F.lit(2.0) * F.asin(F.sqrt(F.when(a > 1.0, F.lit(1.0)).otherwise(a))))


# Hexagonal grid parameters.  Not H3: a planar pointy-top hex grid over local
# equirectangular metres, valid at city scale (not across the poles or the
# antimeridian).  Cell size at resolution 9 matches the published average
# H3 resolution-9 hexagon area; every resolution step scales the edge by sqrt 7.
HEX_REF_LAT = 28.6139                       # reference centre latitude
HEX_RES9_AREA_M2 = 105332.513               # published mean H3 res-9 area
HEX_KY = EARTH_RADIUS_KM * 1000.0 * DEG_TO_RAD           # metres per degree latitude
HEX_KX = HEX_KY * math.cos(HEX_REF_LAT * DEG_TO_RAD)     # metres per degree longitude
HEX_SQRT3_OVER_3 = math.sqrt(3.0) / 3.0


HEX_EDGE_RES9_M = math.sqrt(2.0 * HEX_RES9_AREA_M2 / (3.0 * math.sqrt(3.0)))


def hex_edge(resolution: ColumnOrName | int = HEX_RESOLUTION) -> Column:
    """Edge length in metres: the res-9 edge scaled by sqrt 7 per step
    (folded to a constant by Catalyst for a literal resolution)."""
    res = F.lit(resolution) if isinstance(resolution, int) else _c(resolution)
    return F.lit(HEX_EDGE_RES9_M) * F.pow(F.sqrt(F.lit(7.0)), (F.lit(9) - res).cast("double"))


def usable_position(lat: ColumnOrName = "latitude", lon: ColumnOrName = "longitude") -> Column:
    """Both coordinates present and in range (NaN, infinite or larger ones are not)."""
    a, b = _c(lat), _c(lon)
    return F.coalesce(a.between(-90.0, 90.0) & b.between(-180.0, 180.0), F.lit(False))


def hex_cell(lat: ColumnOrName = "latitude", lon: ColumnOrName = "longitude",
             resolution: int = HEX_RESOLUTION) -> Column:
    """Deterministic hexagonal zone id ``hx_{q}_{r}`` (axial coordinates).

    Pure column arithmetic with cube rounding; the same expression is written
    in the DuckDB oracle so both engines produce the same id.
    """
    e = hex_edge(resolution)
    x = F.when(usable_position(lat, lon), _c(lon)) * HEX_KX
    y = F.when(usable_position(lat, lon), _c(lat)) * HEX_KY
    q = (F.lit(HEX_SQRT3_OVER_3) * x - y / 3.0) / e
    r = (F.lit(2.0) * y / 3.0) / e
    s = -q - r
    rq, rr, rs = F.floor(q + 0.5), F.floor(r + 0.5), F.floor(s + 0.5)
    dq, dr, ds = F.abs(rq - q), F.abs(rr - r), F.abs(rs - s)
    q_fix = (dq > dr) & (dq > ds)
    r_fix = ~q_fix & (dr > ds)
    qi = F.when(q_fix, -rr - rs).otherwise(rq).cast("bigint")
    ri = F.when(r_fix, -rq - rs).otherwise(rr).cast("bigint")
    out = F.concat(F.lit("hx_"), qi.cast("string"), F.lit("_"), ri.cast("string"))
    return F.when(usable_position(lat, lon), out)


def with_hex_cell(df: DataFrame, lat: str = "latitude", lon: str = "longitude",
                  resolution: int = HEX_RESOLUTION, out: str = "h3_cell") -> DataFrame:
    """``hex_cell`` as staged projections: each intermediate (axial q, r, s,
    their roundings and residuals) is a column computed once.  The single
    expression repeats them inside CASE branches, where subexpression
    elimination does not reach (several times slower); Catalyst keeps these
    projections apart because their expensive outputs are used more than
    once, and whole-stage codegen fuses them.  Same ids as ``hex_cell``."""
    e = hex_edge(resolution)
    c = F.col
    # the range test is made once: an unusable position has no y, and so no cell
    staged = df.withColumn("_hy", F.when(usable_position(lat, lon), c(lat) * HEX_KY))
    staged = staged.withColumns({
        "_hq": (F.lit(HEX_SQRT3_OVER_3) * (c(lon) * HEX_KX) - c("_hy") / 3.0) / e,
        "_hr": (F.lit(2.0) * c("_hy") / 3.0) / e,
    }).withColumn("_hs", -c("_hq") - c("_hr"))
    staged = staged.withColumns({f"_r{k}": F.floor(c(f"_h{k}") + 0.5) for k in "qrs"})
    staged = staged.withColumns({f"_d{k}": F.abs(c(f"_r{k}") - c(f"_h{k}")) for k in "qrs"})
    q_fix = (c("_dq") > c("_dr")) & (c("_dq") > c("_ds"))
    r_fix = ~q_fix & (c("_dr") > c("_ds"))
    qi = F.when(q_fix, -c("_rr") - c("_rs")).otherwise(c("_rq")).cast("bigint")
    ri = F.when(r_fix, -c("_rq") - c("_rs")).otherwise(c("_rr")).cast("bigint")
    cell = F.concat(F.lit("hx_"), qi.cast("string"), F.lit("_"), ri.cast("string"))
    temps = ["_hy", *(f"_{a}{k}" for a in "hrd" for k in "qrs")]
    return staged.withColumn(out, cell).drop(*temps)


# --------------------------------------------------------------------------
# Exact rounding of means and percentages
# --------------------------------------------------------------------------

#: Speeds from here on are unusable (they are quarantined when decoded).
MAX_SPEED_KMH = 1e9


def finite_speed(speed: ColumnOrName = "speed_kmh") -> Column:
    """The speed if it can be used; NULL, NaN, infinite and absurd ones give NULL,
    so mean, maximum and minimum skip the same rows."""
    s = _c(speed)
    return F.when(F.abs(s) < MAX_SPEED_KMH, s)


def exact_speed(speed: ColumnOrName = "speed_kmh") -> Column:
    """Usable speed as a decimal of nine digits: its sum does not depend on row order
    or shuffle layout (a double sum does), and the mean can be rounded once."""
    return finite_speed(speed).cast("decimal(18,9)")


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def exact_mean_2dp(total: ColumnOrName, n: ColumnOrName) -> Column:
    """``round(total / n, 2)`` of a decimal sum, half away from zero, without rounding before."""
    s, k = _c(total).cast("decimal(32,9)"), _c(n)
    sign = F.when(s < 0, F.lit(-1)).otherwise(F.lit(1)).cast("bigint")
    return F.when(k > 0, (sign * _div(F.abs(s) * 200 + k, k * 2)) / F.lit(100.0))


def exact_percent_2dp(part: ColumnOrName, total: ColumnOrName) -> Column:
    """``round(part/total*100, 2)`` half up, computed in integers."""
    p, t = _c(part), _c(total)
    return F.when(t > 0, _div(p.cast("bigint") * 20000 + t, t.cast("bigint") * 2) / F.lit(100.0))


def micros_to_km(micro_km_sum: ColumnOrName) -> Column:
    return _c(micro_km_sum) / F.lit(1e6)


def km_to_micros(km: ColumnOrName) -> Column:
    """Distance in integer millionths of a km (6 digits, as the payload)."""
    return F.round(_c(km) * 1e6).cast("bigint")


# --------------------------------------------------------------------------
# Time
# --------------------------------------------------------------------------

MIN_MILLIS, MAX_MILLIS = -62_135_596_800_000, 253_402_300_799_999


def parse_event_time(ts_str: ColumnOrName = "ts_str", timestamp: ColumnOrName = "timestamp") -> Column:
    """Event time from whichever encoding the message carries.

    ``ts_str`` (ISO-8601) first, then ``timestamp`` as epoch milliseconds when
    it is all digits, else ``timestamp`` as an ISO-8601 string.  Milliseconds
    are kept (``timestamp_millis``), zone is the session zone (UTC).
    Unparseable values give NULL (``try_`` forms never raise under ANSI).
    """
    a, b = _c(ts_str), _c(timestamp)
    millis = b.try_cast("bigint")
    # years 1 to 9999; anything else would overflow the conversion
    from_millis = F.timestamp_millis(F.when(millis.between(MIN_MILLIS, MAX_MILLIS), millis))
    from_b = F.when(b.rlike(r"^-?[0-9]+$"), from_millis).otherwise(F.try_to_timestamp(b))
    return F.coalesce(F.try_to_timestamp(a), from_b)


def epoch_micros_ntz(ts: ColumnOrName) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ, independent of zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), _c(ts))
