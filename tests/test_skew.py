"""A trip holding a third of all polls: spread over slices, results unchanged."""

import datetime as dt
import random

import pandas as pd
from pyspark.sql import functions as F

from headway.operators import ordered as od
from headway.plans import punctuality as pn
from test_reference_emulation import DAY, MID, _emulate


def _polls(rng):
    polls, sched, pid = [], [], 0
    for trip in range(1, 42):
        per_stop = 150 if trip == 1 else 15         # trip 1: 1500 of 4500 polls
        for seq in range(1, 11 if trip == 1 else 6):
            arr = MID + 3600 * 6 + trip * 900 + seq * 60
            sched.append((trip, seq, arr))
            for _ in range(per_stop):
                pid += 1
                vts = arr + rng.randint(-200, 200)
                polls.append((pid, vts + 3, trip, vts, rng.choice(["IN_TRANSIT_TO", "STOPPED_AT"]), seq,
                              f"V{trip % 3}"))
    return polls, sched


def test_hot_trip_is_split_and_exact(spark):
    rng = random.Random(5)
    polls, sched = _polls(rng)
    hot = sum(1 for p in polls if p[2] == 1)
    assert abs(hot / len(polls) - 1 / 3) < 0.02

    landed = spark.createDataFrame(
        [(str(i), tf, str(t), "1", v, str(ts), s, q, "FULL", DAY) for i, tf, t, ts, s, q, v in polls],
        "id string, timefetch long, vehicle_trip_tripId string, vehicle_trip_routeId string, vehicle_vehicle_id string, "
        "vehicle_timestamp string, vehicle_currentStatus string, vehicle_currentStopSequence long, "
        "vehicle_occupancyStatus string, service_date date")
    positions = pn.two_day_positions(landed, DAY)

    # the hot trip spans several slices and no slice holds much more than its share
    sliced = od.slice_by_order(positions, pn.ORDER, num_slices=8)
    sizes = [r["n"] for r in sliced.groupBy(od.SLICE).agg(F.count(F.lit(1)).alias("n")).collect()]
    hot_slices = sliced.where(F.col("trip_id") == 1).select(od.SLICE).distinct().count()
    assert hot_slices >= 2
    assert max(sizes) <= 2 * len(polls) / len(sizes)

    schedule = spark.createDataFrame(
        [(t, f"{(a - MID) // 3600:02d}:{(a - MID) % 3600 // 60:02d}:{(a - MID) % 60:02d}", 100 + q, q) for t, q, a in sched],
        "trip_id long, arrival_time string, stop_id long, stop_sequence long")
    spark.conf.set(od.SLICES_CONF, "8")
    try:
        got = {r.id: r.offset for r in pn.offsets(positions, pn.stop_times_unix(schedule, DAY)).collect()}
        # a schedule key that occurs twice repeats its polls, and does not hide them from W1
        twice = pn.stop_times_unix(schedule, DAY)
        assert pn.positions_on_schedule(positions, twice.union(twice)).count() == 2 * pn.positions_on_schedule(positions, twice).count()
    finally:
        spark.conf.unset(od.SLICES_CONF)
    want = _emulate(pd.DataFrame(polls, columns=["id", "timefetch", "trip_id", "vts", "status", "seq", "veh"]),
                    pd.DataFrame(sched, columns=["trip_id", "seq", "arr"]))
    assert got == want
