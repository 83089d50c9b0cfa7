"""Physical-plan checks: pruning, pushdown and shuffle shape."""
from pyspark.sql import functions as F

from geopulse.operators import enrich as E
from geopulse.operators import trips as TR
from geopulse.operators import windows as W
from geopulse.plans import batch
from geopulse.session import scratch_dir
from geopulse.sinks import lake

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _stored_pings(spark):
    path = scratch_dir(spark, "t-plans")
    batch.pings(spark, SF).write.parquet(path)
    return spark.read.parquet(path)


def test_status_filter_and_columns_reach_the_scan(spark):
    p = _stored_pings(spark)
    plan = _plan(W.trip_sessions(E.enrich(p)))
    scan = [line for line in plan.splitlines() if "FileScan" in line][0]
    assert "EqualTo(status,on_trip)" in scan
    assert "speed_kmh" in scan and "ping_id" not in scan.split("ReadSchema")[1]


def test_lake_partition_pruning(spark):
    path = scratch_dir(spark, "t-lake")
    e = batch.enriched(spark, SF)
    lake.write_lake(e, path)
    back = lake.read_lake(spark, path, e.schema).filter(F.col("hour") == "02")
    plan = _plan(back)
    assert "PartitionFilters: [isnotnull(hour" in plan
    assert back.count() == e.filter(F.hour("event_time") == 2).count()


def test_shuffle_counts(spark):
    p = _stored_pings(spark)
    e = E.enrich(p)
    counts = {
        "zone_occupancy": (_plan(W.zone_occupancy(e)), 2),
        "trip_sessions": (_plan(W.trip_sessions(e)), 2),
        "derived_speed": (_plan(TR.derived_speed(p)), 3),
        "trip_segments": (_plan(TR.trip_segments(p)), 4),
    }
    for name, (plan, n) in counts.items():
        assert plan.count("Exchange hashpartitioning") <= n, name
        assert "BroadcastExchange" not in plan and "CartesianProduct" not in plan, name
    assert "SortMergeJoin" not in counts["derived_speed"][0]


def test_sliding_metrics_read_the_pings_once(spark):
    df = W.perf_metrics_sliding(E.enrich(_stored_pings(spark)))
    df.collect()
    plan = _plan(df)
    final = plan[:plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_lake_files_follow_the_size_of_an_hour(spark):
    """As many files as an hour's size needs, not one of each of the 24 tasks: several of a busy hour (and
    of hours that share its shuffle partition), one of the others."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    e = batch.enriched(spark, SF)
    busy = e.where(F.hour("event_time") == 2)
    for _ in range(6):
        busy = busy.unionByName(busy)
    rows = e.where(F.hour("event_time") != 2).unionByName(busy).repartition(24)
    path = scratch_dir(spark, "t-lake-files")
    spark.conf.set(key, "128k")
    try:
        lake.write_lake(rows, path)
    finally:
        spark.conf.set(key, before)
    files = {r[0]: r[1] for r in spark.read.text(path).groupBy(F.regexp_extract(F.input_file_name(), "hour=([0-9]+)", 1))
             .agg(F.count_distinct(F.input_file_name())).collect()}
    busy_files = files.pop("02")
    assert 2 < busy_files < 24 and max(files.values()) <= busy_files and list(files.values()).count(1) >= 2


def test_records_per_object(spark):
    path = scratch_dir(spark, "t-lake-objects")
    e = batch.enriched(spark, SF)
    lake.write_lake(e, path, records_per_object=100)
    files = spark.read.text(path).groupBy(F.input_file_name()).count()
    assert files.agg(F.max("count")).first()[0] <= 100
