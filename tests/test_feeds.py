"""Flattening, station documents, drifted polls."""

import json

from pyspark.sql import functions as F

from headway.plans import feeds as fd


def test_flatten_vehicle_feed(spark):
    msg = {"header": {"gtfsRealtimeVersion": "2.0"}, "entity": [
        {"id": "1", "vehicle": {"trip": {"tripId": "900", "routeId": "24"}, "currentStopSequence": 3,
                                "currentStatus": "STOPPED_AT", "timestamp": "1701442860", "vehicle": {"id": "V1"},
                                "position": {"latitude": 45.5, "longitude": -73.6}}},
        {"id": "2", "vehicle": {"trip": {"tripId": "901"}, "timestamp": "1701442870"}}]}
    raw = spark.createDataFrame([(json.dumps(msg), 1701442900)], "value string, timefetch long")
    out = fd.flatten_feed(raw, fd.VEHICLE_ENTITY, keep=["timefetch"])
    assert out.columns == sorted(out.columns)
    rows = {r.id: r for r in out.collect()}
    assert rows["1"].vehicle_trip_tripId == "900" and rows["1"].vehicle_position_latitude == 45.5
    assert rows["1"].vehicle_vehicle_id == "V1" and rows["2"].vehicle_trip_routeId is None
    assert rows["2"].timefetch == 1701442900


def test_trip_updates_keep_arrays(spark):
    msg = {"entity": [{"id": "e", "tripUpdate": {"trip": {"tripId": "7"},
                                                 "stopTimeUpdate": [{"stopSequence": 1, "stopId": "a"},
                                                                    {"stopSequence": 2, "stopId": "b"}]}}]}
    out = fd.flatten_feed(spark.createDataFrame([(json.dumps(msg),)], "value string"), fd.TRIP_UPDATE_ENTITY)
    r = out.first()
    assert [u.stopId for u in r.tripUpdate_stopTimeUpdate] == ["a", "b"]


def test_empty_feed(spark):
    out = fd.flatten_feed(spark.createDataFrame([(json.dumps({"header": {}}),)], "value string"), fd.VEHICLE_ENTITY)
    assert out.count() == 0


def test_station_snapshot(spark):
    doc = {"last_updated": 1, "data": {"stations": [{"station_id": "1", "num_bikes_available": 3},
                                                     {"station_id": "2", "is_renting": 1}]}}
    out = fd.station_snapshot(spark.createDataFrame([(json.dumps(doc),)], "value string"))
    assert sorted((r.station_id, r.num_bikes_available) for r in out.collect()) == [("1", 3), ("2", None)]


def test_merge_polls_and_timefetch_from_name(spark):
    a = spark.createDataFrame([(1, 2)], "a int, b int").withColumn("file_path", F.lit("s3://b/2020/01/01/x_123456.parquet"))
    b = (spark.createDataFrame([(3, 4, 99)], "a int, c int, timefetch long")
         .withColumn("file_path", F.lit("s3://b/2020/01/01/y_777.parquet")))
    bad = spark.createDataFrame([(5,)], "a int").withColumn("file_path", F.lit("s3://b/2020/01/01/noname.parquet"))
    merged = fd.conform_polls(fd.merge_polls([a, b, bad]))
    assert merged.columns == ["a", "b", "c", "timefetch"]
    assert sorted((tuple(r) for r in merged.collect()), key=lambda r: r[0]) == [(1, 2, None, 123456), (3, None, 4, 99), (5, None, None, None)]
