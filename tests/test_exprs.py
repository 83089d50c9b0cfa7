import math

from pyspark.sql import functions as F
from pyspark.sql import types as T

from geopulse.functions import exprs as X


def _one(spark, schema, rows, col):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_anomaly_rule_table(spark):
    rows = [(s, st) for s in (-0.01, 0.0, 120.0, 120.01) for st in ("available", "on_trip")]
    rows += [(None, "available"), (float("nan"), "available")]
    schema = "speed double, status string"
    got = _one(spark, schema, rows, X.anomaly_type("speed", "status"))
    assert got == ["NEGATIVE_SPEED", "NEGATIVE_SPEED", "NORMAL", "NORMAL", "NORMAL", "NORMAL",
                   "IMPOSSIBLE_SPEED", "NORMAL", None, "NORMAL"]


def test_trip_category_rule_table(spark):
    rows = [(v,) for v in (-1, 0, 1, 299, 300, 899, 900)] + [(None,)]
    got = _one(spark, "d int", rows, X.trip_category("d"))
    assert got == [1, 0, 1, 1, 2, 2, 3, None]


def test_haversine(spark):
    rows = [(28.6, 77.2, 28.6, 77.2), (0.0, 0.0, 0.0, 1.0)]
    got = _one(spark, "a double, b double, c double, d double", rows, X.haversine_km("a", "b", "c", "d"))
    assert got[0] == 0.0
    assert math.isclose(got[1], 6371 * math.pi / 180, rel_tol=1e-12)


def test_haversine_symmetric(spark):
    rows = [(28.61, 77.21, 28.62, 77.19)]
    s = "a double, b double, c double, d double"
    ab = _one(spark, s, rows, X.haversine_km("a", "b", "c", "d"))[0]
    ba = _one(spark, s, rows, X.haversine_km("c", "d", "a", "b"))[0]
    assert math.isclose(ab, ba, rel_tol=1e-12)


def test_hex_cell_neighbours_and_nulls(spark):
    rows = [(28.6139, 77.2090), (28.6139, 77.2090), (28.6239, 77.2090), (None, 77.2)]
    got = _one(spark, "lat double, lon double", rows, X.hex_cell("lat", "lon"))
    assert got[0] == got[1] and got[0].startswith("hx_")
    assert got[2] != got[0]
    assert got[3] is None


def test_hex_cell_size_scales_with_resolution(spark):
    # ~1 km apart: different cells at res 9, same cell at res 6 (edge x 7^1.5)
    rows = [(28.6139, 77.2090), (28.6189, 77.2110)]
    r9 = _one(spark, "lat double, lon double", rows, X.hex_cell("lat", "lon", 9))
    r6 = _one(spark, "lat double, lon double", rows, X.hex_cell("lat", "lon", 6))
    assert r9[0] != r9[1] and r6[0] == r6[1]


def test_exact_mean_half_away_from_zero(spark):
    from decimal import Decimal
    rows = [(Decimal(s), n) for s, n in (("0.05", 2), ("-0.05", 2), ("0.01", 3), ("-0.01", 3), ("0", 0))]
    got = _one(spark, "s decimal(28,9), n long", rows, X.exact_mean_2dp("s", "n"))
    assert got == [0.03, -0.03, 0.0, 0.0, None]
    assert all(not (isinstance(v, float) and math.copysign(1, v) < 0 and v == 0) for v in got if v is not None)


def test_exact_percent(spark):
    rows = [(1, 3), (2, 3), (1, 8), (0, 0)]
    got = _one(spark, "k long, n long", rows, X.exact_percent_2dp("k", "n"))
    assert got == [33.33, 66.67, 12.5, None]


def test_parse_event_time_encodings(spark):
    rows = [("2026-05-17T10:00:00.123456", None), (None, "2026-05-17T10:00:00.5"),
            (None, "1779012000123"), (None, "not a time"), (None, None)]
    df = spark.createDataFrame(rows, "ts_str string, timestamp string")
    got = [r[0] for r in df.select(X.parse_event_time("ts_str", "timestamp").cast("string")).collect()]
    assert got[0] == "2026-05-17 10:00:00.123456"
    assert got[1] == "2026-05-17 10:00:00.5"
    assert got[2] == "2026-05-17 10:00:00.123"
    assert got[3] is None and got[4] is None


def test_unusable_speeds_are_skipped(spark):
    rows = [(12.31,), (float("nan"),), (None,), (-0.01,), (float("inf"),), (-1e300,)]
    got = _one(spark, "s double", rows, X.exact_speed("s"))
    assert [None if v is None else float(v) for v in got] == [12.31, None, None, -0.01, None, None]


def test_mean_is_rounded_once(spark):
    """Three-digit speeds: six of 10.004 and four of 10.014 have the mean 10.008."""
    rows = [(10.004,)] * 6 + [(10.014,)] * 4
    df = spark.createDataFrame(rows, "s double").select(X.exact_speed("s").alias("e"))
    assert df.selectExpr("sum(e) AS t", "count(e) AS n").select(X.exact_mean_2dp("t", "n")).first()[0] == 10.01


def test_haversine_of_a_missing_point_is_null(spark):
    rows = [(None, 1.0), (1.0, None), (0.0, 0.0)]
    got = _one(spark, "a double, b double", rows, X.haversine_km("a", "b", F.lit(0.0), F.lit(0.0)))
    assert got == [None, None, 0.0]


def test_unusable_positions_have_no_cell(spark):
    rows = [(1e300, 1.0), (float("nan"), 1.0), (1.0, float("inf")), (91.0, 0.0)]
    assert _one(spark, "lat double, lon double", rows, X.hex_cell("lat", "lon")) == [None] * 4


def test_times_out_of_range_are_null(spark):
    rows = [("999999999999999999",), ("-999999999999999999",), ("1000",)]
    got = _one(spark, "t string", rows, X.parse_event_time(F.lit(None).cast("string"), "t").isNull())
    assert got == [True, True, False]


def test_sql_functions_equal_column_functions(spark):
    from geopulse.plans import batch
    from geopulse.plans.sql_surface import register_functions
    register_functions(spark)
    p = batch.pings(spark, "/root/testdata/sf0.001")
    p.createOrReplaceTempView("pings_t")
    sql = spark.sql(
        "SELECT ping_id, hex_index(latitude, longitude) AS h9, hex_index(latitude, longitude, 7) AS h7, "
        "detect_anomaly(speed_kmh, status) AS a, trip_duration_category(trip_duration_secs) AS c "
        "FROM pings_t")
    col = p.select("ping_id", X.hex_cell(resolution=9).alias("h9"), X.hex_cell(resolution=7).alias("h7"),
                   X.anomaly_type().alias("a"), X.trip_category().alias("c"))
    assert sql.exceptAll(col).count() == 0 and col.exceptAll(sql).count() == 0


def test_staged_hex_equals_single_expression(spark):
    from geopulse.plans import batch
    p = batch.pings(spark, "/root/testdata/sf0.01").union(
        spark.createDataFrame([(-1, "DRV_X", None, 77.2, "available", 1.0, 0, None, None, None)], batch.pings(
            spark, "/root/testdata/sf0.001").schema))
    for res in (9, 7, 11):
        a = p.select("ping_id", X.hex_cell(resolution=res).alias("h"))
        b = X.with_hex_cell(p, resolution=res, out="h").select("ping_id", "h")
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_sql_forms_of_the_zone_agree_with_the_column_form(spark):
    from geopulse.plans.sql_surface import enriched_view_sql, register_functions
    from geopulse.functions.exprs import hex_cell
    odd = [(28.6, 77.2), (float("nan"), 77.2), (28.6, float("inf")), (float("-inf"), 1.0), (200.0, 1.0), (1e300, 1.0), (1.0, -1e300),
           (None, 1.0), (1.0, None), (90.0, 180.0), (-90.0, -180.0), (28.61, -77.3)]
    register_functions(spark)
    rows = [(i, "d", a, b, "on_trip", 1.0, 5, None) for i, (a, b) in enumerate(odd)]
    df = spark.createDataFrame(rows, "ping_id int, driver_id string, latitude double, longitude double, status string, speed_kmh double, "
                                     "trip_duration_secs int, event_time timestamp")
    df.createOrReplaceTempView("odd_pings")
    want = {r.ping_id: r.cell for r in df.select("ping_id", hex_cell().alias("cell")).collect()}
    scalar = {r.ping_id: r.cell for r in spark.sql("SELECT ping_id, hex_index(latitude, longitude) AS cell FROM odd_pings").collect()}
    staged = {r.ping_id: r.h3_cell for r in spark.sql(enriched_view_sql("odd_pings")).collect()}
    assert scalar == want == staged
    assert sum(v is None for v in want.values()) == 8
    plan = spark.sql(enriched_view_sql("odd_pings"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") > 3 and "Join" not in plan  # stages of their own, no join
