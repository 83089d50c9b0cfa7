"""Spark SQL text for the domain expressions.

Used for the SQL surface (temporary SQL functions over a view, P7/U4).  Numeric
constants come from ``functions.exprs`` and are written as double literals (a
bare decimal literal is DECIMAL).
"""

from __future__ import annotations

from ..functions import exprs as X
from ..schema import (
    ANOMALY_IMPOSSIBLE, ANOMALY_NEGATIVE, ANOMALY_NORMAL, HEX_RESOLUTION,
    IMPOSSIBLE_SPEED_KMH, MEDIUM_TRIP_SECS, SHORT_TRIP_SECS, STATUS_AVAILABLE,
)


def dbl(v: float) -> str:
    r = repr(float(v))
    return r if ("e" in r or "inf" in r or "nan" in r) else r + "e0"


def hex_stages(lat: str, lon: str, resolution: int | str = HEX_RESOLUTION) -> list[str]:
    """Select lists that lead from coordinates to ``hex_cell``, each over the ones before: every
    intermediate is written once.  Unusable coordinates (missing, NaN, out of range) give NULL."""
    return [
        f"{lat} BETWEEN -90e0 AND 90e0 AND {lon} BETWEEN -180e0 AND 180e0 AS ok, "
        f"{dbl(X.HEX_EDGE_RES9_M)} * pow(sqrt(7e0), CAST(9 - {resolution} AS DOUBLE)) AS edge",
        f"CASE WHEN ok THEN {lon} * {dbl(X.HEX_KX)} END AS x, CASE WHEN ok THEN {lat} * {dbl(X.HEX_KY)} END AS y",
        f"({dbl(X.HEX_SQRT3_OVER_3)} * x - y / 3e0) / edge AS q, (2e0 * y / 3e0) / edge AS r",
        "-q - r AS s",
        "floor(q + 0.5e0) AS rq, floor(r + 0.5e0) AS rr, floor(s + 0.5e0) AS rs",
        "abs(rq - q) AS dq, abs(rr - r) AS dr, abs(rs - s) AS ds",
        "dq > dr AND dq > ds AS fix_q",
        "concat('hx_', CAST(CASE WHEN fix_q THEN -rr - rs ELSE rq END AS BIGINT), '_', "
        "CAST(CASE WHEN NOT fix_q AND dr > ds THEN -rq - rs ELSE rr END AS BIGINT)) AS hex_cell",
    ]


def hex_lateral(lat: str, lon: str, resolution: int | str = HEX_RESOLUTION) -> str:
    """The stages as LATERAL items of a FROM clause, which give ``hex_cell``: Spark makes each a projection."""
    return ", ".join(f"LATERAL (SELECT {stage}) AS hex_{i}" for i, stage in enumerate(hex_stages(lat, lon, resolution)))


def hex_sql(lat: str, lon: str, resolution: int | str = HEX_RESOLUTION) -> str:
    """The stages as one scalar expression (nested subqueries without a table)."""
    first, *rest = hex_stages(lat, lon, resolution)
    body = f"SELECT {first}"
    for stage in rest[:-1]:
        body = f"SELECT *, {stage} FROM ({body})"
    return f"(SELECT {rest[-1]} FROM ({body}))"


def anomaly_sql(speed: str, status: str) -> str:
    return (f"CASE WHEN {speed} IS NULL THEN NULL "
            f"WHEN {speed} < 0 THEN '{ANOMALY_NEGATIVE}' "
            f"WHEN {speed} > {IMPOSSIBLE_SPEED_KMH} AND NOT isnan({speed}) "
            f"AND {status} = '{STATUS_AVAILABLE}' THEN '{ANOMALY_IMPOSSIBLE}' "
            f"ELSE '{ANOMALY_NORMAL}' END")


def trip_category_sql(d: str) -> str:
    return (f"CAST(CASE WHEN {d} IS NULL THEN NULL WHEN {d} = 0 THEN 0 "
            f"WHEN {d} < {SHORT_TRIP_SECS} THEN 1 WHEN {d} < {MEDIUM_TRIP_SECS} THEN 2 "
            f"ELSE 3 END AS BIGINT)")


def finite_speed_sql(speed: str) -> str:
    return f"CASE WHEN abs({speed}) < {dbl(X.MAX_SPEED_KMH)} THEN {speed} END"


def exact_speed_sql(speed: str) -> str:
    return f"CAST({finite_speed_sql(speed)} AS DECIMAL(18,9))"


def exact_mean_sql(s: str, n: str) -> str:
    return (f"CASE WHEN {n} > 0 THEN (CASE WHEN {s} < 0 THEN -1 ELSE 1 END) * "
            f"((abs(CAST({s} AS DECIMAL(32,9))) * 200 + {n}) div ({n} * 2)) / 100e0 END")


def exact_percent_sql(part: str, total: str) -> str:
    return f"CASE WHEN {total} > 0 THEN ((20000 * {part} + {total}) div (2 * {total})) / 100e0 END"
