"""C4-C6 on hand-computed polls: every offset rule, the 7200 s and 1800 s cuts, segments."""

import datetime as dt

from headway.plans import punctuality as pn

DAY = dt.date(2023, 12, 1)
MID = 1701406800                      # local midnight of the service day
T = {"10:00:00": MID + 36000, "10:10:00": MID + 36600, "10:20:00": MID + 37200,
     "10:30:00": MID + 37800, "11:00:00": MID + 39600}

SCHEDULE = [  # trip_id, arrival_time, departure_time, stop_id, stop_sequence
    (100, "10:00:00", "10:00:00", 11, 1), (100, "10:10:00", "10:10:00", 12, 2),
    (100, "10:20:00", "10:20:00", 13, 3), (101, "10:30:00", "10:30:00", 21, 1),
    (102, "11:00:00", "11:00:00", 31, 1),
]


def _poll(day, pid, trip, seq, vts, status, vehicle, tf_delta=10):
    return (str(pid), vts + tf_delta, str(trip), "7", vehicle, str(vts), status, seq, "FULL", day)


POLLS = [
    _poll(DAY, 1, 100, 1, T["10:00:00"] + 60, "STOPPED_AT", "V1"),        # R1: 60
    _poll(DAY, 2, 100, 1, T["10:00:00"] + 120, "STOPPED_AT", "V1"),       # R1: 120
    _poll(DAY, 3, 100, 2, T["10:10:00"] - 100, "IN_TRANSIT_TO", "V1"),    # R2: next poll of the trip
    _poll(DAY, 4, 100, 2, T["10:10:00"] + 30, "IN_TRANSIT_TO", "V1"),     # W1: repeated, dropped
    _poll(DAY, 5, 100, 3, T["10:20:00"] - 50, "IN_TRANSIT_TO", "V1"),     # R3: next trip, same vehicle
    _poll(DAY, 6, 101, 1, T["10:30:00"] + 10, "STOPPED_AT", "V1"),        # R1: 10
    _poll(DAY, 7, 101, 1, T["10:30:00"] + 2000, "STOPPED_AT", "V1"),      # R1: 2000 > 1800
    _poll(DAY, 8, 102, 1, T["11:00:00"] - 100, "IN_TRANSIT_TO", "V9"),    # exact W1 drops it
    # next-day poll of the same trip and stop: beyond 7200 s of the schedule
    _poll(DAY + dt.timedelta(days=1), 9, 100, 1, T["10:00:00"] + 86400 + 5, "STOPPED_AT", "V1"),
]
POLL_SCHEMA = ("id string, timefetch long, vehicle_trip_tripId string, vehicle_trip_routeId string, "
               "vehicle_vehicle_id string, vehicle_timestamp string, vehicle_currentStatus string, "
               "vehicle_currentStopSequence long, vehicle_occupancyStatus string, service_date date")


def _inputs(spark):
    polls = spark.createDataFrame(POLLS, POLL_SCHEMA)
    schedule = spark.createDataFrame(SCHEDULE, "trip_id long, arrival_time string, departure_time string, "
                                               "stop_id long, stop_sequence long")
    return pn.two_day_positions(polls, DAY), schedule


def test_two_day_read_and_casts(spark):
    positions, _ = _inputs(spark)
    assert positions.count() == 9
    types = dict(positions.dtypes)
    assert types["id"] == "int" and types["trip_id"] == "bigint" and types["vehicle_timestamp"] == "bigint"


def test_filter_positions_exact_vs_per_trip(spark):
    positions, _ = _inputs(spark)
    exact = {r.id for r in pn.filter_positions(positions, exact=True).collect()}
    per_trip = {r.id for r in pn.filter_positions(positions, exact=False).collect()}
    assert 4 not in exact and 4 not in per_trip          # repeated in-transit poll
    assert 8 not in exact                                 # same sequence as the previous trip's last row
    assert 8 in per_trip                                  # first poll of its trip
    assert exact == {1, 2, 3, 5, 6, 7, 9}


def test_offset_rules(spark):
    positions, schedule = _inputs(spark)
    stu = pn.stop_times_unix(schedule, DAY)
    got = {r.id: r.offset for r in pn.offsets(positions, stu).collect()}
    assert got == {1: 60, 2: 120, 3: 550, 5: 610, 6: 10, 7: 2000}


def test_stop_punctuality(spark):
    positions, schedule = _inputs(spark)
    rows = pn.stop_punctuality(positions, schedule, DAY).collect()
    got = {(r.trip_id, r.stop_sequence): (r.arrival_time_offset, r.departure_time_offset, r.offset, r.vehicleID,
                                          r.routeId, r.stop_id, r.arrival_time_unix) for r in rows}
    assert got == {
        (100, 1): (60, 120, 90.0, 1, 7, 11, T["10:00:00"]),
        (100, 2): (550, 550, 550.0, 3, 7, 12, T["10:10:00"]),
        (100, 3): (610, 610, 610.0, 5, 7, 13, T["10:20:00"]),
        (101, 1): (10, 2000, 1005.0, 6, 7, 21, T["10:30:00"]),   # first/last taken before the 1800 s cut
    }


def test_segments(spark):
    positions, schedule = _inputs(spark)
    data_stops = pn.stop_punctuality(positions, schedule, DAY)
    trips = spark.createDataFrame([(100, 7, "S7a"), (99, 7, "S7b"), (101, 7, "S7a")],
                                  "trip_id long, route_id long, shape_id string")
    rows = pn.segment_delays(data_stops, trips).collect()
    got = sorted((r.trip_id, r.previous_stop_id, r.stop_id, r.offset_difference, r.shape_id) for r in rows)
    assert got == [(100, 11, 12, 460, "S7b"), (100, 12, 13, 60, "S7b")]
