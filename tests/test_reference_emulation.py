"""C4/C5 offsets vs a plain pandas emulation of the sorted-frame logic, on random polls.

``shift`` over the whole frame, per-trip shifts, first/last per stop.
"""

import datetime as dt
import random

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from headway.plans import punctuality as pn

DAY = dt.date(2023, 12, 1)
MID = 1701406800
ORDER = ["trip_id", "seq", "timefetch", "vts", "id"]


def _emulate(polls: pd.DataFrame, sched: pd.DataFrame) -> dict:
    df = polls.sort_values(ORDER, kind="mergesort").reset_index(drop=True)
    changed = df["seq"].diff().ne(0) & df["seq"].diff().notna()
    keep = (changed & (df.status == "IN_TRANSIT_TO")) | (df.status == "STOPPED_AT")
    df = df[keep].merge(sched, on=["trip_id", "seq"], how="inner")
    df = df[(df.timefetch - df.arr).abs() <= 7200].sort_values(ORDER, kind="mergesort").reset_index(drop=True)
    off = pd.Series([pd.NA] * len(df), dtype="Int64")
    off[df.status == "STOPPED_AT"] = (df.vts - df.arr)[df.status == "STOPPED_AT"]
    nxt_trip, nxt_vts, nxt_veh = df.trip_id.shift(-1), df.vts.shift(-1), df.veh.shift(-1)
    r2 = (df.status == "IN_TRANSIT_TO") & (df.trip_id == nxt_trip)
    off[r2] = (nxt_vts - df.arr)[r2]
    max_seq = df.groupby("trip_id").seq.transform("max")
    r3 = (df.status != "STOPPED_AT") & (df.veh == nxt_veh) & (df.seq == max_seq)
    off[r3] = (nxt_vts - df.arr)[r3]
    return {int(i): (None if pd.isna(o) else int(o)) for i, o in zip(df.id, off)}


@settings(max_examples=8, deadline=None)
@given(st.integers(0, 10_000))
def test_offsets_match_emulation(spark, seed):
    rng = random.Random(seed)
    polls, sched, pid = [], [], 0
    for trip in range(1, rng.randint(2, 7)):
        veh = f"V{rng.randint(1, 2)}"
        for seq in range(1, rng.randint(2, 5)):
            arr = MID + 3600 * 8 + trip * 600 + seq * 120
            sched.append((trip, seq, arr))
            for _ in range(rng.randint(0, 3)):
                pid += 1
                vts = arr + rng.randint(-300, 300)
                day_shift = 86400 if rng.random() < 0.1 else 0
                polls.append((pid, vts + day_shift + 5, trip, vts + day_shift, rng.choice(["IN_TRANSIT_TO", "STOPPED_AT"]),
                              seq, veh))
    if not polls:
        return
    pdf = pd.DataFrame(polls, columns=["id", "timefetch", "trip_id", "vts", "status", "seq", "veh"])
    sdf = pd.DataFrame(sched, columns=["trip_id", "seq", "arr"])
    want = _emulate(pdf, sdf)

    landed = spark.createDataFrame(
        [(str(i), tf, str(t), "1", v, str(ts), s, q, "FULL", DAY) for i, tf, t, ts, s, q, v in polls],
        "id string, timefetch long, vehicle_trip_tripId string, vehicle_trip_routeId string, vehicle_vehicle_id string, "
        "vehicle_timestamp string, vehicle_currentStatus string, vehicle_currentStopSequence long, "
        "vehicle_occupancyStatus string, service_date date")
    schedule = spark.createDataFrame(
        [(t, f"{(a - MID) // 3600:02d}:{(a - MID) % 3600 // 60:02d}:{(a - MID) % 60:02d}", 100 + q, q) for t, q, a in sched],
        "trip_id long, arrival_time string, stop_id long, stop_sequence long")
    stu = pn.stop_times_unix(schedule, DAY)
    got = {r.id: r.offset for r in pn.offsets(pn.two_day_positions(landed, DAY), stu).collect()}
    assert got == want
