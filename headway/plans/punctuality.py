"""Bus punctuality: position filter (C4), stop lateness (C5), segment deltas.

Row order is meaningful in this analysis: neighbours are taken in the total
order ``ORDER`` over the whole frame, exactly like the reference's sorted-frame
``shift``/``diff``, but computed on range slices (``operators.ordered``) so no
trip, however hot, lands in one task.  Per-stop results come from one
partial-aggregating ``groupBy`` instead of group-bys joined back to detail.

Shuffle plan of ``stop_punctuality``: one range exchange of the narrow polls
and one by slice for W1, positions x schedule on (trip, stop sequence) [J3], one
exchange by slice for the next poll and the trip's last stop (a segmented scan:
one summary row per slice, broadcast) and the stops' results, of which only those
that slice edges cut are combined.  After each of the four the narrow rows are
pinned, and what led to them is deleted: the disk holds one step at a time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import DEFAULT_TZ, as_date, service_clock_to_epoch
from ..operators.ordered import (first_last_keep_by_slice, pin, segmented_scan, slice_by_order, stored_slices, unpin,
                                 with_group_ends, with_neighbour)

SEQ = "vehicle_currentStopSequence"
STATUS = "vehicle_currentStatus"
STOPPED_AT = "STOPPED_AT"
IN_TRANSIT_TO = "IN_TRANSIT_TO"
# H3: total order of position rows (ties never survive it)
ORDER = ["trip_id", SEQ, "timefetch", "vehicle_timestamp", "id"]
WITHIN_STOP = ["timefetch", "vehicle_timestamp", "id"]

POLL_WINDOW_S = 7200      # P9: poll time vs schedule
OFFSET_LIMIT_S = 1800     # P9: kept lateness

# Strict casts applied to landed position columns (when present)
POSITION_TYPES = {
    "id": "int",
    "timefetch": "bigint",
    "vehicle_position_bearing": "int",
    "vehicle_position_latitude": "double",
    "vehicle_position_longitude": "double",
    "vehicle_position_speed": "double",
    "vehicle_timestamp": "bigint",
    "trip_id": "bigint",
}

DATA_STOPS_COLUMNS = ["trip_id", "arrival_time", "stop_id", "stop_sequence", "arrival_time_unix",
                      "vehicleID", "Current_Occupancy", "offset", "routeId",
                      "arrival_time_offset", "departure_time_offset"]
SEGMENT_COLUMNS = ["trip_id", "routeId", "stop_id", "previous_stop_id", "offset_difference",
                   "Current_Occupancy", "arrival_time_unix"]


# ---------------------------------------------------------------- inputs

def stop_times_unix(stop_times: DataFrame, day: str | dt.date, tz: str = DEFAULT_TZ) -> DataFrame:
    """F1 + F2: schedule rows with ``arrival_time_unix`` (departure_time dropped)."""
    return stop_times.select(
        "trip_id", "arrival_time", "stop_id", "stop_sequence",
        service_clock_to_epoch(F.col("arrival_time"), day, tz).alias("arrival_time_unix"))


def prepare_positions(raw: DataFrame) -> DataFrame:
    """P1 + P4: ``vehicle_trip_tripId`` -> ``trip_id`` and strict casts."""
    df = raw.withColumnRenamed("vehicle_trip_tripId", "trip_id")
    return df.select(*[F.col(c).cast(POSITION_TYPES[c]).alias(c) if c in POSITION_TYPES else F.col(c)
                       for c in df.columns])


def two_day_positions(positions: DataFrame, day: str | dt.date) -> DataFrame:
    """SRC11 + U1: the service day's polls and the next day's (trips past midnight).

    ``positions`` is keyed by ``service_date`` (a partition column on disk), so
    this is one pruned scan rather than two reads and a concat.
    """
    d = as_date(day)
    picked = positions.where(F.col("service_date").isin(d, d + dt.timedelta(days=1)))
    return prepare_positions(picked.drop("service_date"))


# ---------------------------------------------------------------- C4

def _keep_polled(prev: str, exact: bool) -> Column:
    """W1 + P7: keep STOPPED_AT rows and IN_TRANSIT_TO rows whose stop sequence changed."""
    seq, prev_seq = F.col(SEQ), F.col(prev).getField(SEQ)
    if exact:
        # difference to the previous row of the whole sorted frame; null -> dropped
        changed = seq != prev_seq
    else:
        first_of_trip = F.col(prev).isNull() | ~F.col(prev).getField("trip_id").eqNullSafe(F.col("trip_id"))
        changed = F.when(first_of_trip, F.lit(True)).otherwise(seq != prev_seq)
    status = F.col(STATUS)
    return (changed & (status == IN_TRANSIT_TO)) | (status == STOPPED_AT)


def filter_positions(positions: DataFrame, exact: bool = False) -> DataFrame:
    """C4: drop repeated IN_TRANSIT_TO polls.

    ``exact=False`` compares with the previous poll of the same trip (the
    intent); ``exact=True`` with the previous row of the whole sorted frame,
    across trip borders, as the reference does.
    """
    sliced = slice_by_order(positions, ORDER)
    with_prev = with_neighbour(sliced, ORDER, ["trip_id", SEQ], "prev", "_prev")
    return with_prev.where(_keep_polled("_prev", exact)).drop("_prev", "_slice")


# ---------------------------------------------------------------- C5

def _kept_polls(positions: DataFrame, exact: bool) -> DataFrame:
    """W1/P7 over all polls, pinned with their slice tag; the slices of all polls are deleted."""
    sliced = stored_slices(positions, ORDER)
    kept = pin(with_neighbour(sliced, ORDER, ["trip_id", SEQ], "prev", "_prev")
               .where(_keep_polled("_prev", exact) & F.col("vehicle_timestamp").isNotNull()).drop("_prev"))
    unpin(sliced)
    return kept


def _on_schedule(kept: DataFrame, stu: DataFrame) -> DataFrame:
    """J3 + P8 + P9 of the kept polls; the rows keep their slice tag.

    W1 comes before the join, so a schedule key that occurs twice repeats the
    kept poll and cannot make its copy look unchanged.
    """
    schedule = stu.withColumnRenamed("stop_sequence", SEQ)
    # null times are dropped by the coalesce: as a filter of its own, "is not null" would move down to
    # the scan of the schedule and work out the clock of every row a second time
    near = F.abs(F.col("timefetch") - F.col("arrival_time_unix")) <= POLL_WINDOW_S
    return kept.join(schedule, ["trip_id", SEQ]).where(F.coalesce(near, F.lit(False)))


def positions_on_schedule(positions: DataFrame, stu: DataFrame, exact: bool = True) -> DataFrame:
    """J3 + P8 + P9: filtered polls matched to their scheduled stop within 2 h."""
    return _on_schedule(_kept_polls(positions, exact), stu).drop("_slice")


NEXT_COLS = ["trip_id", "vehicle_vehicle_id", "vehicle_timestamp"]
# what C5 needs of a poll on schedule
NARROW = [*ORDER, "_slice", STATUS, "vehicle_vehicle_id", "vehicle_occupancyStatus", "vehicle_trip_routeId",
          "arrival_time", "stop_id", "arrival_time_unix"]


def _offsets(positions: DataFrame, stu: DataFrame, exact: bool, upto: str,
             columns: list[str] | None = None, spent: list[DataFrame] | None = None) -> DataFrame:
    """The pinned frame that the result reads is added to ``spent``, for a caller that pins the result."""
    if columns:
        positions = positions.select(*[c for c in positions.columns if c in columns])
    kept = _kept_polls(positions, exact)
    rows = _on_schedule(kept, stu)
    arrival = F.col("arrival_time_unix")
    status = F.col(STATUS)
    # R1
    stopped = F.when(status == STOPPED_AT, F.col("vehicle_timestamp") - arrival)
    if upto == "stopped":
        return rows.withColumn("offset", stopped)
    # J3 is evaluated here, once: the summary of the slices and the pass over them read its rows
    rows = pin(rows.select(*columns) if columns else rows)
    unpin(kept)
    if spent is not None:
        spent.append(rows)
    last_stop = {"group": ["trip_id"], "value": SEQ, "out_max": "_max_seq"} if upto == "last_stop" else {}
    rows = segmented_scan(rows, ORDER, NEXT_COLS, "_next", **last_stop).withColumn("offset", stopped)
    nxt = F.col("_next")
    # R2: an in-transit poll is late by the time of the trip's next poll
    rows = rows.withColumn("offset", F.when(
        (status == IN_TRANSIT_TO) & (nxt.getField("trip_id") == F.col("trip_id")),
        nxt.getField("vehicle_timestamp") - arrival).otherwise(F.col("offset")))
    if upto == "in_transit":
        return rows.drop("_next")
    # At the trip's last stop, the next poll of the same vehicle (any trip)
    same_vehicle = F.col("vehicle_vehicle_id") == nxt.getField("vehicle_vehicle_id")
    rows = rows.withColumn("offset", F.when(
        (status != STOPPED_AT) & same_vehicle & (F.col(SEQ) == F.col("_max_seq")),
        F.when(same_vehicle, nxt.getField("vehicle_timestamp")) - arrival).otherwise(F.col("offset")))
    return rows.drop("_next", "_max_seq")


def offsets(positions: DataFrame, stu: DataFrame, exact: bool = True, upto: str = "last_stop") -> DataFrame:
    """Per-poll offset after rule R1 (``upto="stopped"``), R2 (``"in_transit"``) or R3."""
    return _offsets(positions, stu, exact, upto).drop("_slice")


def arrival_departure_offsets(positions: DataFrame, stu: DataFrame, exact: bool = True) -> DataFrame:
    """W4 + A1 + P9: each kept poll with the first/last offset of its stop (before the 1800 s cut)."""
    spent = []
    rows = pin(_offsets(positions, stu, exact, "last_stop", spent=spent))
    unpin(*spent)
    ended = with_group_ends(rows, ["trip_id", SEQ], ORDER, "offset", "arrival_time_offset", "departure_time_offset")
    return ended.where(F.abs(F.col("offset")) <= OFFSET_LIMIT_S).drop("_slice")


def stop_punctuality(positions: DataFrame, stop_times: DataFrame, day: str | dt.date,
                     tz: str = DEFAULT_TZ, exact: bool = True) -> DataFrame:
    """C5 -> ``data_stops``: one row per (trip, stop) with arrival/departure lateness.

    ``positions`` are the prepared polls of the service day and the next day
    (``two_day_positions``); ``stop_times`` the day's filtered schedule.
    """
    stu = stop_times_unix(stop_times, day, tz)
    spent = []
    rows = _offsets(positions, stu, exact, "last_stop", NARROW, spent)
    # W4 + A4 + the 1800 s cut in one pass per stop, slice by slice:
    # first/last offset by poll order, and the earliest poll that survives the cut.
    # The schedule columns ride along (GTFS keys stop times by trip and sequence),
    # so J4 needs no second join with the schedule.
    per_stop = first_last_keep_by_slice(
        rows, ["trip_id", SEQ], WITHIN_STOP, "offset",
        keep_when=F.abs(F.col("offset")) <= OFFSET_LIMIT_S,
        keep_cols=["id", "vehicle_occupancyStatus", "vehicle_trip_routeId",
                   "arrival_time", "stop_id", "arrival_time_unix"])
    unpin(*spent)
    kept = F.col("kept")
    return per_stop.where(kept.isNotNull()).select(
        "trip_id",
        kept.getField("arrival_time").alias("arrival_time"),
        kept.getField("stop_id").alias("stop_id"),
        F.col(SEQ).alias("stop_sequence"),
        kept.getField("arrival_time_unix").alias("arrival_time_unix"),
        kept.getField("id").alias("vehicleID"),
        kept.getField("vehicle_occupancyStatus").alias("Current_Occupancy"),
        ((F.col("first_offset") + F.col("last_offset")) / 2).alias("offset"),
        kept.getField("vehicle_trip_routeId").cast("bigint").alias("routeId"),
        F.col("first_offset").alias("arrival_time_offset"),
        F.col("last_offset").alias("departure_time_offset"))


# ---------------------------------------------------------------- C6

def segment_deltas(data_stops: DataFrame) -> DataFrame:
    """W7 + P5: lateness gained or lost since the previous stop of the same trip."""
    order = ["trip_id", "stop_sequence", "arrival_time_unix"]
    wanted = [c for c in SEGMENT_COLUMNS if c in data_stops.columns]
    # pinned before it is sliced: a range exchange samples its input first, which would run C5 twice
    rows = pin(data_stops.where(F.col("offset").isNotNull()).select(*dict.fromkeys([*order, *wanted, "offset"])))
    sliced = stored_slices(rows, order)
    unpin(rows)
    with_prev = with_neighbour(sliced, order, ["trip_id", "stop_id", "offset"], "prev", "_prev")
    prev = F.col("_prev")
    return (with_prev
            .where(F.col("trip_id") == prev.getField("trip_id"))
            .withColumn("previous_stop_id", prev.getField("stop_id"))
            .withColumn("offset_difference", F.col("offset") - prev.getField("offset"))
            .where(F.col("offset_difference").isNotNull())
            .withColumn("offset_difference", F.col("offset_difference").cast("bigint"))
            .select(*SEGMENT_COLUMNS))


def route_shape_map(trips: DataFrame) -> DataFrame:
    """A3: one shape per route, deterministically the shape of the smallest trip id."""
    return trips.groupBy("route_id").agg(F.min_by("shape_id", "trip_id").alias("shape_id"))


def segment_delays(data_stops: DataFrame, trips: DataFrame) -> DataFrame:
    """C6 -> ``segments``: segment deltas with the route's shape (J9, left join)."""
    seg = segment_deltas(data_stops)
    shapes = route_shape_map(trips)
    return (seg.join(shapes, seg["routeId"] == shapes["route_id"], "left")
            .select(*[seg[c] for c in SEGMENT_COLUMNS], shapes["shape_id"]))
