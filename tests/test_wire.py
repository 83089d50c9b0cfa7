from pyspark.sql import functions as F

from geopulse.plans import batch
from geopulse.sources import wire


def test_decode_time_encodings_and_quarantine(spark):
    msgs = [
        '{"driver_id":"DRV_7","latitude":28.612345,"longitude":77.201234,"status":"on_trip",'
        '"speed_kmh":43.21,"timestamp":"2026-05-17T10:00:00.123456","trip_duration_secs":120}',
        '{"driver_id":"DRV_7","latitude":28.6,"longitude":77.2,"status":"available",'
        '"speed_kmh":1.0,"ts_str":"2026-05-17T10:00:01","trip_duration_secs":0}',
        '{"driver_id":"DRV_8","latitude":28.6,"longitude":77.2,"status":"available",'
        '"speed_kmh":1.0,"timestamp":1779012002123,"trip_duration_sec":7,"trip_distance_km":1.5}',
        '{"driver_id":"DRV_9","latitude":28.6}',
        'this is not json',
    ]
    df = spark.createDataFrame([(m,) for m in msgs], "value string")
    good, bad = wire.decode_with_quarantine(df)
    g = good.orderBy("event_time").collect()
    assert len(g) == 3
    assert str(g[0].event_time) == "2026-05-17 10:00:00.123456"
    assert g[2].trip_duration_secs == 7 and g[2].trip_distance_km == 1.5
    reasons = sorted(r.reason for r in bad.collect())
    assert reasons == ["no_event_time", "not_json"]
    assert good.count() + bad.count() == df.count()


def test_encode_decode_identity(spark):
    p = batch.pings(spark, "/root/testdata/sf0.001").withColumns({
        "latitude": F.round("latitude", 6), "longitude": F.round("longitude", 6),
        "speed_kmh": F.round("speed_kmh", 2)}).drop("trip_distance_km")  # the producer does not send it
    for enc in ("iso", "ts_str"):
        back = wire.to_canonical(wire.decode(wire.encode(p, enc))).withColumn(
            "event_time", F.col("event_time").cast("timestamp_ntz")).drop("trip_distance_km")
        assert back.exceptAll(p).count() == 0 and p.exceptAll(back).count() == 0


def test_encoded_key_is_driver(spark):
    p = batch.pings(spark, "/root/testdata/sf0.001")
    e = wire.encode(p, "millis")
    assert e.columns == ["key", "value"]
    assert e.filter(~F.col("value").contains(F.col("key"))).count() == 0


def test_missing_non_time_field_is_kept_with_nulls(spark):
    from geopulse.operators import enrich as E
    msgs = ['{"ping_id":1,"driver_id":"DRV_1","latitude":28.6,"longitude":77.2,'
            '"status":"available","ts_str":"2026-05-17T10:00:00"}']
    good, bad = wire.decode_with_quarantine(spark.createDataFrame([(m,) for m in msgs], "value string"))
    assert bad.count() == 0
    (row,) = E.enrich(good).collect()
    assert row.speed_kmh is None and row.anomaly_type is None and row.trip_category is None
    assert row.h3_cell.startswith("hx_")


def test_ping_id_filled_when_absent(spark):
    msgs = ['{"driver_id":"DRV_7","latitude":28.6,"longitude":77.2,"status":"on_trip",'
            '"speed_kmh":1.0,"timestamp":"2026-05-17T10:00:00","trip_duration_secs":0}',
            '{"ping_id":42,"driver_id":"DRV_7","latitude":28.6,"longitude":77.2,"status":"on_trip",'
            '"speed_kmh":1.0,"timestamp":"2026-05-17T10:00:00","trip_duration_secs":0}']
    df = spark.createDataFrame([(m, 1000 + i) for i, m in enumerate(msgs)], "value string, off long")
    ids = sorted(r.ping_id for r in wire.decode(df).collect())
    assert None not in ids and 42 in ids
    assert sorted(r.ping_id for r in wire.decode(df).collect()) == ids  # deterministic
    assert sorted(r.ping_id for r in wire.decode(df, fallback_id="off").collect()) == [42, 1000]
