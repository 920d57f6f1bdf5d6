"""File-side jobs on scratch folders: merge day, landing, bike history with reruns, refresh, stats."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, LongType, StructField, StructType

from headway.plans import jobs
from headway.plans.static_refresh import refresh_static
from headway.sinks import files
from headway.sources import gtfs

HEADER = ("STARTSTATIONNAME,STARTSTATIONARRONDISSEMENT,STARTSTATIONLATITUDE,STARTSTATIONLONGITUDE,"
          "ENDSTATIONNAME,ENDSTATIONARRONDISSEMENT,ENDSTATIONLATITUDE,ENDSTATIONLONGITUDE,STARTTIMEMS,ENDTIMEMS")


def _csv(path, rows, header=HEADER):
    with open(path, "w") as f:
        f.write(header + "\n")
        for r in rows:
            f.write(",".join(str(x) for x in r) + "\n")
    return path


def _trips(start, n, station_prefix="s"):
    return [(f"{station_prefix}{i % 3}", "Plateau", 45.5, -73.5, f"{station_prefix}{(i + 1) % 3}", "Ville-Marie",
             45.51, -73.56, start + i * 1000, float(start + i * 1000 + 600000)) for i in range(n)]


def test_merge_day_drifted_polls(spark, scratch):
    day_dir = os.path.join(scratch, "landing", "2020", "01", "01")
    os.makedirs(day_dir)
    spark.createDataFrame([(1, 2)], "a int, b int").coalesce(1).write.parquet(os.path.join(scratch, "tmp_a"))
    spark.createDataFrame([(3, 4.5, 99)], "a int, c double, timefetch long").coalesce(1).write.parquet(
        os.path.join(scratch, "tmp_b"))
    for name, src in [("poll_123456.parquet", "tmp_a"), ("poll_777.parquet", "tmp_b")]:
        part = [f for f in os.listdir(os.path.join(scratch, src)) if f.endswith(".parquet")][0]
        os.rename(os.path.join(scratch, src, part), os.path.join(day_dir, name))
    schema = StructType([StructField("a", IntegerType()), StructField("b", DoubleType()),
                         StructField("c", DoubleType()), StructField("timefetch", LongType())])
    out = os.path.join(scratch, "merged")
    jobs.merge_day_job(spark, os.path.join(scratch, "landing"), out, "2020-01-01", schema)
    got = spark.read.parquet(out)
    assert sorted(got.columns) == ["a", "b", "c", "service_date", "timefetch"]
    assert sorted((r.a, r.b, r.c, r.timefetch) for r in got.collect()) == [(1, 2.0, None, 123456), (3, None, 4.5, 99)]
    assert len([f for f in os.listdir(os.path.join(out, "service_date=2020-01-01")) if f.endswith(".parquet")]) == 1
    # rerun replaces the day instead of appending to it
    jobs.merge_day_job(spark, os.path.join(scratch, "landing"), out, "2020-01-01", schema)
    assert spark.read.parquet(out).count() == 2


def test_land_feed_and_station_status(spark, scratch):
    raw = os.path.join(scratch, "raw_vp")
    os.makedirs(raw)
    msg = {"entity": [{"id": "1", "vehicle": {"trip": {"tripId": "5"}, "timestamp": "1701442860"}}]}
    with open(os.path.join(raw, "vehicles_1701442900.json"), "w") as f:
        json.dump(msg, f)
    out = os.path.join(scratch, "vp")
    from headway.plans.feeds import VEHICLE_ENTITY
    jobs.land_feed_job(spark, raw, out, VEHICLE_ENTITY)
    r = spark.read.parquet(out).first()
    assert (r.vehicle_trip_tripId, r.timefetch, r.service_date) == ("5", 1701442900, dt.date(2023, 12, 1))

    raw_s = os.path.join(scratch, "raw_gbfs")
    os.makedirs(raw_s)
    with open(os.path.join(raw_s, "docks_1701442900.json"), "w") as f:
        json.dump({"data": {"stations": [{"station_id": "1", "num_bikes_available": 4}]}}, f)
    out_s = os.path.join(scratch, "status")
    jobs.land_station_status_job(spark, raw_s, out_s)
    r = spark.read.parquet(out_s).first()
    assert (r.station_id, r.num_bikes_available, r.timefetch) == ("1", 4, 1701442900)


def test_bike_history_load_rerun_and_ledger(spark, scratch):
    f1 = _csv(os.path.join(scratch, "file1.csv"), _trips(1_700_000_000_000, 20))
    f2 = _csv(os.path.join(scratch, "file2.csv"), _trips(1_700_000_500_000, 20))
    bad = _csv(os.path.join(scratch, "bad.csv"), [(1, 2)], header="a,b")
    trips_p, stations_p = os.path.join(scratch, "trips"), os.path.join(scratch, "stations")
    stats = jobs.load_bike_trips(spark, [f1, f2, bad], trips_p, stations_p)
    assert stats["trips"] == 40 and stats["stations"] == 3 and stats["skipped"] == [bad]
    # rerun of the same files: everything is at or below the stored mark, nothing is duplicated
    again = jobs.load_bike_trips(spark, [f1, f2], trips_p, stations_p)
    assert again["trips"] == 0 and again["stations"] == 0
    assert spark.read.parquet(trips_p).count() == 40
    durations = {r.durationMs for r in spark.read.parquet(trips_p).collect()}
    assert durations == {600000.0}


def test_missing_file_and_empty_catalogue_load_nothing(spark, scratch):
    missing = os.path.join(scratch, "nope.csv")
    stats = jobs.load_bike_trips(spark, [missing], os.path.join(scratch, "trips"), os.path.join(scratch, "stations"))
    assert stats == {"trips": 0, "stations": 0, "skipped": [missing]}
    empty = spark.createDataFrame([], "year int, url string")
    assert jobs.historical_load(spark, empty, {}, os.path.join(scratch, "t"), os.path.join(scratch, "s"),
                                os.path.join(scratch, "l"), "https://cdn.example.com") == []


def test_historical_load_orders_years_and_dispatches(spark, scratch):
    f = _csv(os.path.join(scratch, "y2023.csv"), _trips(1_690_000_000_000, 5, "t"))
    entries = spark.createDataFrame([(2023, "http://x.example/a/2023.zip?q=1"), (2015, "https://cdn.example.com/2015.zip")],
                                    "year int, url string")
    paths = {"https://cdn.example.com/a/2023.zip": [f]}
    ledger = os.path.join(scratch, "ledger")
    done = jobs.historical_load(spark, entries, paths, os.path.join(scratch, "trips"),
                                os.path.join(scratch, "stations"), ledger, "https://cdn.example.com")
    assert [(d["year"], d["status"]) for d in done] == [(2015, "skipped"), (2023, "loaded")]
    assert [r.url for r in spark.read.parquet(ledger).collect()] == ["https://cdn.example.com/a/2023.zip"]
    with pytest.raises(ValueError):
        files.add_ledger_entry(spark, ledger, "https://cdn.example.com/a/2023.zip", 2023)
    old = spark.createDataFrame([(2010, "https://cdn.example.com/2010.zip")], "year int, url string")
    with pytest.raises(ValueError):
        jobs.historical_load(spark, old, {}, os.path.join(scratch, "t2"), os.path.join(scratch, "s2"),
                             os.path.join(scratch, "l2"), "https://cdn.example.com")


def test_refresh_static_freshness(spark, scratch):
    feed = os.path.join(scratch, "feed")
    os.makedirs(feed)
    with open(os.path.join(feed, "calendar.txt"), "w") as f:
        f.write("service_id,monday,tuesday,wednesday,thursday,friday,saturday,sunday,start_date,end_date\n"
                "A,1,1,1,1,1,0,0,20231101,20231231\n")
    with open(os.path.join(feed, "stop_times.txt"), "w") as f:
        f.write("trip_id,stop_id,stop_sequence,arrival_time,departure_time\nT1,S1,1,10:00:00,10:00:00\n")
    out, ledger = os.path.join(scratch, "static"), os.path.join(scratch, "ledger")
    assert refresh_static(spark, feed, out, "Fri, 01 Dec 2023 10:00:00 GMT", ledger)        # never stored
    cal = spark.read.parquet(os.path.join(out, "calendar"))
    assert dict(cal.dtypes)["friday"] == "int" and cal.first().service_id == "A"
    st = spark.read.parquet(os.path.join(out, "stop_times")).first()
    assert (st.stop_id, st.stop_sequence, st.arrival_time) == ("S1", 1, "10:00:00")       # columns by header name
    assert not refresh_static(spark, feed, out, "Fri, 01 Dec 2023 10:00:00 GMT", ledger)    # equal: up to date
    assert not refresh_static(spark, feed, out, "Thu, 30 Nov 2023 10:00:00 GMT", ledger)    # older
    assert refresh_static(spark, feed, out, "Sat, 02 Dec 2023 10:00:00 GMT", ledger)        # newer
    assert spark.read.parquet(ledger).count() == 1


def _write_json(folder, name, value):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(value if isinstance(value, str) else json.dumps(value))


def test_landing_keeps_every_poll_and_unknown_members(spark, scratch):
    from headway.plans.feeds import VEHICLE_ENTITY
    out = os.path.join(scratch, "vehicles")
    for at in (1701442900, 1701443000):
        raw = os.path.join(scratch, f"raw{at}")
        _write_json(raw, f"vehicles_{at}.json", {"entity": [
            {"id": "7", "colour": "red", "vehicle": {"trip": {"tripId": "12", "note": {"kind": "extra"}}, "timestamp": str(at)}}]})
        jobs.land_feed_job(spark, raw, out, VEHICLE_ENTITY)
    rows = spark.read.parquet(out).orderBy("timefetch").collect()
    assert [r.timefetch for r in rows] == [1701442900, 1701443000]
    assert [(r.colour, r.vehicle_trip_note_kind) for r in rows] == [("red", "extra")] * 2
    jobs.land_feed_job(spark, os.path.join(scratch, "raw1701443000"), out, VEHICLE_ENTITY)     # the same poll again
    assert spark.read.parquet(out).count() == 2


def test_landing_puts_bad_messages_aside(spark, scratch):
    raw, out = os.path.join(scratch, "raw"), os.path.join(scratch, "docks")
    _write_json(raw, "docks_1701442900.json", {"data": {"stations": [{"id": 5, "name": "Quay"}, {"id": 6, "name": "Park"}]}})
    _write_json(raw, "docks_1701442960.json", '{"data": {"stations": [{"id": 5, "na')
    _write_json(raw, "undated.json", {"data": {"stations": []}})
    jobs.land_station_status_job(spark, raw, out)
    assert sorted(r.name for r in spark.read.parquet(out).collect()) == ["Park", "Quay"]
    rejects = spark.read.parquet(out + "_rejects").collect()
    assert sorted(os.path.basename(r.path) for r in rejects) == ["docks_1701442960.json", "undated.json"]


def test_merge_day_unites_unknown_columns_and_lists_rejects(spark, scratch):
    day = os.path.join(scratch, "landing", "2020", "01", "02")
    for name, frame in (("poll_5", spark.createDataFrame([(1, "new")], "a int, extra string")),
                        ("poll_6", spark.createDataFrame([(2,)], "a int")), ("late", spark.createDataFrame([(3,)], "a int"))):
        tmp = os.path.join(scratch, "tmp_" + name)
        frame.coalesce(1).write.parquet(tmp)
        os.makedirs(day, exist_ok=True)
        os.rename(os.path.join(tmp, next(f for f in os.listdir(tmp) if f.endswith(".parquet"))), os.path.join(day, name + ".parquet"))
    with open(os.path.join(day, "poll_7.parquet"), "wb") as f:
        f.write(b"PAR1 cut short")
    schema = StructType([StructField("a", IntegerType()), StructField("timefetch", LongType())])
    out = os.path.join(scratch, "merged")
    jobs.merge_day_job(spark, os.path.join(scratch, "landing"), out, "2020-01-02", schema)
    assert sorted((r.a, r.extra, r.timefetch) for r in spark.read.parquet(out).collect()) == [(1, "new", 5), (2, None, 6)]
    rejects = {os.path.basename(r.path): r.reason for r in spark.read.parquet(out + "_rejects").collect()}
    assert rejects == {"poll_7.parquet": "not a Parquet file", "late.parquet": "rows without a poll time"}


def test_corrupt_day_fails(spark, scratch):
    out = os.path.join(scratch, "days")
    spark.range(10).withColumn("service_date", F.lit(dt.date(2024, 1, 1))).repartition(2).write.partitionBy("service_date").parquet(out)
    part = os.path.join(out, "service_date=2024-01-01")
    name = next(f for f in sorted(os.listdir(part)) if f.endswith(".parquet"))
    with open(os.path.join(part, name), "r+b") as f:
        f.truncate(40)
    with pytest.raises(Exception):
        gtfs.read_day(spark, out, "2024-01-01", schema=StructType(
            [StructField("id", LongType()), StructField("service_date", DateType())])).collect()


def test_bike_load_survives_a_stop_after_each_step(spark, scratch, monkeypatch):
    source = _csv(os.path.join(scratch, "f.csv"), _trips(1_700_000_000_000, 6))
    trips, stations = os.path.join(scratch, "trips"), os.path.join(scratch, "stations")
    for step in ("insert_if_absent", "append"):
        with monkeypatch.context() as m:
            m.setattr(jobs.files, step, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("stopped")))
            with pytest.raises(RuntimeError):
                jobs.load_bike_trips(spark, [source], trips, stations)
    jobs.load_bike_trips(spark, [source], trips, stations)
    assert spark.read.parquet(trips).count() == 6
    assert sorted(r.name for r in spark.read.parquet(stations).collect()) == ["s0", "s1", "s2"]


def test_ledger_holds_loaded_urls_only(spark, scratch):
    entries = spark.createDataFrame([(2024, "https://cdn.example.com/z/2024.zip")], "year int, url string")
    where = [os.path.join(scratch, x) for x in ("t", "s", "l")]
    with pytest.raises(KeyError):
        jobs.historical_load(spark, entries, {}, *where, "https://cdn.example.com")
    done = jobs.historical_load(spark, entries, {"https://cdn.example.com/z/2024.zip": [os.path.join(scratch, "none.csv")]},
                                *where, "https://cdn.example.com")
    assert done[0]["status"] == "empty" and not files.path_exists(spark, where[2])


def test_malformed_number_fails_the_load(spark, scratch):
    rows = [list(r) for r in _trips(1_700_000_000_000, 2)]
    rows[1][8] = "soon"
    with pytest.raises(Exception):
        jobs.load_bike_trips(spark, [_csv(os.path.join(scratch, "f.csv"), rows)], os.path.join(scratch, "t"), os.path.join(scratch, "s"))


def test_poll_date_in_any_session_zone(spark):
    polls = spark.createDataFrame([(1701414000,), (1701406799,)], "t long")       # 00:00 and 23:59:59 before it, local
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("UTC", "America/Montreal", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", other)
            assert [r.d for r in polls.select(jobs.poll_date(F.col("t")).alias("d")).collect()] == [
                dt.date(2023, 12, 1), dt.date(2023, 11, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_path_exists_raises_other_errors(spark, scratch):
    assert not files.path_exists(spark, os.path.join(scratch, "nothing"))
    bad = os.path.join(scratch, "bad")
    os.makedirs(bad)
    with open(os.path.join(bad, "part-0.parquet"), "w") as f:
        f.write("no Parquet file at all")
    with pytest.raises(Exception):
        files.path_exists(spark, bad)


def test_segments_rerun_replaces_the_day(spark, scratch):
    day = dt.date(2024, 5, 6)
    stops, static, out = (os.path.join(scratch, x) for x in ("stops", "static", "segments"))
    spark.createDataFrame([(1, "a", 10, 1, 100, 5, "FULL", 30.0, 3, day), (1, "b", 11, 2, 200, 5, "FULL", 50.0, 3, day)],
                          "trip_id long, arrival_time string, stop_id long, stop_sequence long, arrival_time_unix long, vehicleID int, "
                          "Current_Occupancy string, offset double, routeId long, service_date date").write.partitionBy(
        "service_date").parquet(stops)
    spark.createDataFrame([(1, 3, "S")], "trip_id long, route_id long, shape_id string").write.parquet(static + "/trips")
    for _ in range(2):
        jobs.segments_job(spark, stops, static, out, day, with_index=True)
    assert [(r["index"], r.offset_difference, r.shape_id) for r in spark.read.parquet(out).collect()] == [(0, 20, "S")]


def test_readable_size(spark):
    from headway.functions.labels import readable_size
    rows = spark.createDataFrame([(n,) for n in (0, 1023, 1048474, 1280, 1024 ** 4)], "n long")
    assert [r.s for r in rows.select(readable_size(F.col("n")).alias("s")).collect()] == [
        "0.0 B", "1023.0 B", "1023.9 KiB", "1.2 KiB", "1.0 TiB"]


def test_table_stats(spark, scratch):
    path = os.path.join(scratch, "t")
    spark.range(0, 1000).repartition(3).write.parquet(path)
    r = files.table_stats(spark, path).first()
    assert r.rows == 1000 and r.storage_bytes > 0 and r.size.endswith("B")


def test_header_probe_and_listing(spark, scratch):
    p = _csv(os.path.join(scratch, "x.csv"), [], header="b,a")
    assert gtfs.csv_header(spark, p) == ["b", "a"]
    assert gtfs.list_files(spark, scratch, "*.csv") == ["file:" + p]


def test_day_write_fixed_file_count_and_rewrite(spark, scratch):
    out = os.path.join(scratch, "days")
    df = spark.range(0, 3000).withColumn("service_date", F.when(F.col("id") % 2 == 0, F.lit(dt.date(2024, 1, 1)))
                                         .otherwise(F.lit(dt.date(2024, 1, 2))))
    files.write_day_partitioned(df, out, files_per_day=3)
    for day in ("2024-01-01", "2024-01-02"):
        parts = [f for f in os.listdir(os.path.join(out, f"service_date={day}")) if f.endswith(".parquet")]
        assert 1 <= len(parts) <= 3
    # rewriting one day leaves the other untouched (dynamic partition overwrite)
    files.write_day_partitioned(df.where(F.col("id") % 2 == 0).limit(10), out)
    got = {str(r.service_date): r.n for r in spark.read.parquet(out).groupBy("service_date")
           .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {"2024-01-01": 10, "2024-01-02": 1500}


ENTRIES = [(2023, "https://cdn.example.com/r/early.zip"), (2024, "https://cdn.example.com/r/late.zip")]


def _history(spark, scratch):
    first = _csv(os.path.join(scratch, "early.csv"), _trips(1_700_000_000_000, 6))
    second = _csv(os.path.join(scratch, "late.csv"), _trips(1_700_000_003_000, 6) + _trips(1_700_000_900_000, 2, "z"))
    paths = {ENTRIES[0][1]: [first], ENTRIES[1][1]: [second]}
    where = [os.path.join(scratch, x) for x in ("trips", "stations", "ledger")]
    return lambda: jobs.historical_load(spark, spark.createDataFrame(ENTRIES, "year int, url string"), paths, *where,
                                        "https://cdn.example.com"), where


def _stored(spark, where):
    trips, stations, ledger = (spark.read.parquet(p).collect() for p in where)
    return (sorted(r.startTimeMs for r in trips), sorted(r.name for r in stations), sorted(r.year for r in ledger))


WANTED = ([1_700_000_000_000 + 1000 * k for k in range(9)] + [1_700_000_900_000, 1_700_000_901_000],
          ["s0", "s1", "s2", "z0", "z1", "z2"], [2023, 2024])


@pytest.mark.parametrize("after", range(6))
def test_historical_load_replays_onto_itself(spark, scratch, monkeypatch, after):
    """Stopped after any of its six writes, then run again: every trip, station and ledger row is there once."""
    load, where = _history(spark, scratch)
    written, real = [], files.write_load

    def write_load(df, path, *a, **k):
        real(df, path, *a, **k)
        written.append(path)
        if len(written) == after + 1:
            raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(files, "write_load", write_load)
        with pytest.raises(RuntimeError):
            load()
    done = {r.url for r in spark.read.parquet(where[2]).collect()} if files.path_exists(spark, where[2]) else set()
    entries = [e for e in ENTRIES if e[1] not in done]       # what the catalogue check would give next time
    if entries:
        paths = {ENTRIES[0][1]: [os.path.join(scratch, "early.csv")], ENTRIES[1][1]: [os.path.join(scratch, "late.csv")]}
        jobs.historical_load(spark, spark.createDataFrame(entries, "year int, url string"), paths, *where, "https://cdn.example.com")
    assert _stored(spark, where) == WANTED


def test_two_runs_at_once_leave_each_row_once(spark, scratch, monkeypatch):
    load, where = _history(spark, scratch)
    load()
    # the other run has passed the ledger check before this one recorded its entry
    monkeypatch.setattr(files, "add_ledger_entry", lambda s, path, url, year: files.write_load(
        s.createDataFrame([(url, int(year))], "url string, year int"), path, files.load_name(url)))
    load()
    trips, stations, ledger = _stored(spark, where)
    assert (stations, ledger) == WANTED[1:] and len(trips) == len(set(trips))


def _day_files(folder):
    return [f for _, _, names in os.walk(folder) for f in names if f.endswith(".parquet")]


def test_a_day_of_polls_becomes_a_few_files(spark, scratch):
    landed, days = os.path.join(scratch, "landed"), os.path.join(scratch, "days")
    at = 1701406800                                                            # local midnight
    polls = spark.range(0, 3000).select((F.lit(at) + F.col("id") % 300 * 60).alias("timefetch"), F.col("id").alias("bike"),
                                        F.lit("a").alias("state"))
    jobs.land_rows(polls, landed)
    assert len(_day_files(landed)) == 300
    assert jobs.compact_landed_day(spark, landed, days, "2023-12-01") == 1
    assert len(_day_files(days)) == 1 and spark.read.parquet(days).count() == 3000
    # a poll that lands again replaces itself, a new one is added; the others stay
    again = polls.where(F.col("timefetch") == at + 60).limit(4).withColumn("state", F.lit("b"))
    late = polls.where(F.col("timefetch") == at).withColumn("timefetch", F.col("timefetch") + 36000)
    jobs.land_rows(again.unionByName(late), landed)

    def counts(df):
        return {(r.state, r.late): r.n for r in df.groupBy("state", (F.col("timefetch") == at + 36000).alias("late")).agg(
            F.count(F.lit(1)).alias("n")).collect()}

    want = {("a", False): 2990, ("b", False): 4, ("a", True): 10}
    assert counts(jobs.read_landed_day(spark, landed, days, "2023-12-01")) == want      # before it is folded
    small = jobs.compact_landed_day(spark, landed, days, "2023-12-01", target_bytes=100_000)
    assert counts(spark.read.parquet(days)) == want and 1 < small < 20 and len(_day_files(days)) <= small
    jobs.compact_landed_day(spark, landed, days, "2023-12-01")                          # nothing new: the same day
    assert counts(spark.read.parquet(days)) == want


def test_a_day_without_polls_cannot_be_compacted_into_rows(spark, scratch):
    landed = os.path.join(scratch, "landed")
    jobs.land_rows(spark.createDataFrame([(1701406800, 1)], "timefetch long, bike long"), landed)
    jobs.compact_landed_day(spark, landed, os.path.join(scratch, "days"), "2023-12-02")
    assert _day_files(os.path.join(scratch, "days")) == []
