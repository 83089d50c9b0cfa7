"""One driver holding a third of all pings (FIXTURES rows remapped): results
stay exact, and the hot driver's rows are split over many (driver, bucket)
groups instead of one."""
import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from geopulse.operators import enrich as E
from geopulse.operators import live as L
from geopulse.operators import trips as TR
from geopulse.operators import windows as W
from geopulse.plans import batch
from geopulse.plans.oracle import PINGS_CTE
from tests.test_oracle import _rows

SF = "/root/testdata/sf0.01"
HOT_SQL = "CASE WHEN event_id % 3 = 0 THEN 'DRV_HOT' ELSE concat('DRV_', CAST(user_id AS VARCHAR)) END"


@pytest.fixture(scope="module")
def hot(spark):
    hot_driver = F.when(F.col("ping_id") % 3 == 0, F.lit("DRV_HOT")).otherwise(F.col("driver_id"))
    return batch.pings(spark, SF).withColumn("driver_id", hot_driver)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.sql(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF}/events.parquet')")
    return c


def _oracle(key):
    sql = entry.oracle_sql()[key]
    base = "concat('DRV_', CAST(user_id AS VARCHAR)) AS driver_id"
    assert base in PINGS_CTE
    return sql.replace(base, f"{HOT_SQL} AS driver_id", 1)


@pytest.mark.parametrize("key,fn", [
    ("trip_segments", lambda p: TR.trip_segments(p)),
    ("derived_speed", lambda p: TR.derived_speed(p)),
    ("trip_sessions", lambda p: W.trip_sessions(E.enrich(p))),
    ("zone_occupancy", lambda p: W.zone_occupancy(E.enrich(p))),
    ("live_state", lambda p: L.live_state(E.enrich(p))),
])
def test_hot_driver_exact(hot, con, key, fn):
    assert hot.filter(F.col("driver_id") == "DRV_HOT").count() * 3 >= hot.count() - 3
    s = fn(hot).toPandas()
    o = con.sql(_oracle(key)).df()
    assert _rows(s) == _rows(o)


def test_hot_driver_is_split_by_time(hot):
    p = TR._bucketed(hot, TR.DEFAULT_BUCKET)
    groups = p.filter(F.col("driver_id") == "DRV_HOT").select("_b").distinct().count()
    assert groups >= 6  # ~6 h of compressed time in 1-hour buckets


def test_building_starts_no_job(spark, hot):
    """One plan at every size: nothing is counted while the queries are built."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build-only", "")
    for fn in (TR.trip_segments, TR.derived_speed, TR.haversine_legs):
        fn(hot)
    assert list(tracker.getJobIdsForGroup("build-only")) == []
