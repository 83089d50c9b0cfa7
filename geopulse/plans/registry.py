"""Registry of every query key and its oracle."""

from __future__ import annotations

from ..streaming.queries import STREAM_ORACLES, STREAM_QUERIES
from .batch import BATCH_QUERIES
from .oracle import ORACLE_SQL


def all_queries() -> dict:
    return {**BATCH_QUERIES, **STREAM_QUERIES}


def all_oracles() -> dict:
    return {**ORACLE_SQL, **STREAM_ORACLES}
