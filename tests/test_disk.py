"""What the ordered steps leave on disk: one step at a time, no exchange of a pinned frame, no frame that nothing reads."""

import os
import random
import time
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from headway.operators import ordered as od
from headway.plans import punctuality as pn

BASE = 1701406800
DAY = "2023-12-01"
STOPS = 600


def _shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for f in manager.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}


def _gone(found, before):
    for _ in range(100):
        if not found() - before:
            return True
        time.sleep(0.1)         # files are deleted behind the action that ends
    return False


def _inputs(spark):
    k = F.col("id")
    seen = F.lit(BASE + 36000) + k % 10 * 60
    polls = spark.range(2 * STOPS).select(
        k.cast("int").alias("id"), (seen + 5 + F.floor(k / STOPS)).alias("timefetch"), (F.floor(k % STOPS / 10)).alias("trip_id"),
        F.lit("7").alias("vehicle_trip_routeId"), F.lit("V").alias("vehicle_vehicle_id"), seen.alias("vehicle_timestamp"),
        F.lit("STOPPED_AT").alias("vehicle_currentStatus"), (k % 10).alias("vehicle_currentStopSequence"),
        F.lit("FULL").alias("vehicle_occupancyStatus"), F.lit(1.5).alias("vehicle_position_speed"))
    schedule = spark.range(STOPS).select(
        F.floor(k / 10).alias("trip_id"), F.concat(F.lit("10:0"), (k % 10).cast("string"), F.lit(":00")).alias("arrival_time"),
        k.alias("stop_id"), (k % 10).alias("stop_sequence"))
    return polls, schedule


def _arrival_departure(polls, schedule):
    return pn.arrival_departure_offsets(polls, pn.stop_times_unix(schedule, DAY)), 2 * STOPS


def _per_trip(polls, schedule):
    return pn.stop_punctuality(polls, schedule, DAY, exact=False), STOPS


def _segments(polls, schedule):
    trips = schedule.select("trip_id", F.lit(7).alias("route_id"), F.lit("S").alias("shape_id"))
    return pn.segment_delays(pn.stop_punctuality(polls, schedule, DAY), trips), STOPS - STOPS // 10


# frames with more than a row or two per slice that are left when the query is built
@pytest.mark.parametrize("build, left", [(_arrival_departure, 1), (_per_trip, 1), (_segments, 2)])
def test_only_frames_that_the_result_reads_are_left(spark, build, left):
    folder = urlparse(spark.sparkContext.getCheckpointDir()).path
    spark.conf.set(od.SLICES_CONF, "5")
    try:
        before, moved = set(os.listdir(folder)), _shuffle_files(spark)
        result, rows = build(*_inputs(spark))
        assert _gone(lambda: _shuffle_files(spark), moved)
        new = sorted(set(os.listdir(folder)) - before)
        assert new and all(n.startswith("pinned-") for n in new)
        assert sum(spark.read.parquet(f"{folder}/{n}").count() > 20 for n in new) == left
        assert result.count() == rows
    finally:
        spark.conf.unset(od.SLICES_CONF)


def test_a_pinned_frame_is_stored_and_deleted(spark):
    settings = {k: spark.conf.get(k, None) for k in od.WHILE_PINNED}
    moved = _shuffle_files(spark)
    rows = spark.range(1000).select("id", (F.col("id") % 7).alias("g")).repartition(5, "g")
    pinned = od.pin(rows)
    assert _gone(lambda: _shuffle_files(spark), moved)
    assert {k: spark.conf.get(k, None) for k in od.WHILE_PINNED} == settings
    assert pinned.dtypes == rows.dtypes and sorted(map(tuple, pinned.collect())) == [(i, i % 7) for i in range(1000)]
    od.unpin(pinned)
    assert not os.path.exists(urlparse(pinned._pinned_at).path)


def test_a_frame_that_parquet_cannot_hold_is_pinned_too(spark):
    pinned = od.pin(spark.range(3).select("id", F.lit(None).alias("nothing"), F.struct().alias("empty")))
    od.unpin(pinned)            # a checkpoint stays
    assert sorted(r.id for r in pinned.collect()) == [0, 1, 2] and pinned.first().nothing is None


def test_first_last_keep_by_slice_equals_whole_frame(spark):
    """Groups over many slices, groups whose kept row is in another slice than the first, null groups and values."""
    rng = random.Random(7)
    rows = [(rng.choice([1, 2, 2, 2, 2, 3, None]), rng.choice([1, 1, 1, 2]), i, rng.choice([None, *range(50)])) for i in range(400)]
    df = spark.createDataFrame(rows, "g int, h int, k int, v int")
    keep = F.col("v") > 47
    want = sorted(map(str, od.first_last_keep(df, ["g", "h"], ["k"], "v", keep, ["k", "v"]).collect()))
    for slices in (1, 7, 60):
        sliced = od.by_slice(od.stored_slices(df, ["g", "h", "k"], slices), slices)
        got = od.first_last_keep_by_slice(sliced, ["g", "h"], ["k"], "v", keep, ["k", "v"])
        assert sorted(map(str, got.collect())) == want
