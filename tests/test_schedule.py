"""Calendar filter, semi join, labels."""

import datetime as dt

from pyspark.sql import functions as F

from headway.functions.labels import readable_size, route_info, trusted_url
from headway.plans import schedule as sc

CAL = ("service_id int, start_date string, end_date string, monday int, tuesday int, wednesday int, "
       "thursday int, friday int, saturday int, sunday int")


def test_sunday_flag_with_text_dates(spark):
    cal = spark.createDataFrame([(1, "20221201", "20230131", 0, 0, 0, 0, 0, 0, 1),
                                 (2, "20221201", "20230131", 1, 1, 1, 1, 1, 0, 0),
                                 (3, "20230102", "20230131", 1, 1, 1, 1, 1, 1, 1)], CAL)
    assert [r.service_id for r in sc.active_services(cal, "20230101").collect()] == [1]


def test_calendar_already_dates(spark):
    cal = (spark.createDataFrame([(1, "20221201", "20230131", 0, 0, 0, 0, 0, 0, 1)], CAL)
           .withColumn("start_date", F.to_date("start_date", "yyyyMMdd"))
           .withColumn("end_date", F.to_date("end_date", "yyyyMMdd")))
    assert sc.active_services(cal, dt.date(2023, 1, 1)).count() == 1


def test_filter_service_day_and_repeated_service(spark):
    cal = spark.createDataFrame([(1, "20230101", "20230101", 0, 0, 0, 0, 0, 0, 1)], CAL)
    trips = spark.createDataFrame([(1, "t1"), (1, "t2"), (2, "t3")], "service_id int, trip_id string")
    st = spark.createDataFrame([("t1", "s1", "10:00:00"), ("t3", "s2", "11:00:00")],
                               "trip_id string, stop_id string, arrival_time string")
    active, day_trips, day_st = sc.filter_service_day(cal, trips, st, "20230101")
    assert sorted(r.trip_id for r in day_trips.collect()) == ["t1", "t2"]
    assert [r.trip_id for r in day_st.collect()] == ["t1"]
    # a service listed twice repeats its trips (inner join semantics)
    twice = active.unionByName(active)
    assert sc.filtered_trips(twice, trips).count() == 4


def test_services_by_day_multi_day_form(spark):
    cal = spark.createDataFrame([(1, "20230101", "20230107", 1, 1, 1, 1, 1, 0, 0)], CAL)
    days = spark.createDataFrame([(dt.date(2023, 1, 1),), (dt.date(2023, 1, 2),)], "service_date date")
    got = [(r.service_date, r.service_id) for r in sc.services_by_day(cal, days).collect()]
    assert got == [(dt.date(2023, 1, 2), 1)]


def test_daily_stops_info(spark):
    stops = spark.createDataFrame([("s1", "Berri", 45.5, -73.5, 1)],
                                  "stop_id string, stop_name string, stop_lat double, stop_lon double, "
                                  "wheelchair_boarding int")
    trips = spark.createDataFrame([("t1", "24", "Station X-E", 0, "sh1", 1), ("t2", "55", "Nord", 1, "sh2", 2)],
                                  "trip_id string, route_id string, trip_headsign string, direction_id int, "
                                  "shape_id string, wheelchair_accessible int")
    st = spark.createDataFrame([("t1", "24:00:00", "s1"), ("t2", "08:00:00", "s9")],
                               "trip_id string, arrival_time string, stop_id string")
    routes = spark.createDataFrame([("24", "Sherbrooke")], "route_id string, route_long_name string")
    rows = {r.trip_id: r for r in sc.daily_stops_info(st, trips, stops, routes, "20230101").collect()}
    assert rows["t1"].route_info == "24 Sherbrooke dir. EST"
    assert rows["t1"].arrival_time_unix == 1672635600          # local midnight of 2023-01-02
    assert rows["t1"].stop_name == "Berri"
    assert rows["t2"].route_info is None and rows["t2"].stop_name is None   # missing route / stop


def test_labels(spark):
    df = spark.createDataFrame([("1", "A", "X-O"), ("2", "B", "Y-Q"), ("3", "C", "")],
                               "r string, n string, h string")
    got = [r.v for r in df.select(route_info(F.col("r"), F.col("n"), F.col("h")).alias("v")).collect()]
    assert got == ["1 A dir. OUEST", "2 B dir. Q", "3 C dir. "]
    urls = spark.createDataFrame([("http://evil.example.net/data/2022.zip?x=1#f",), ("/data/a.zip",)], "u string")
    got = [r.v for r in urls.select(trusted_url(F.col("u"), "https://cdn.example.com").alias("v")).collect()]
    assert got == ["https://cdn.example.com/data/2022.zip", "https://cdn.example.com/data/a.zip"]
    sizes = spark.createDataFrame([(512,), (2048,), (5 * 1024 ** 3,)], "b long")
    got = [r.v for r in sizes.select(readable_size(F.col("b")).alias("v")).collect()]
    assert got == ["512.0 B", "2.0 KiB", "5.0 GiB"]
