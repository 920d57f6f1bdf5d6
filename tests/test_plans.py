"""Physical-plan checks: no Python in any plan, bounded single-partition steps, pushdown and pruning."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from headway.operators import ordered
from headway.plans import jobs
from headway.plans import punctuality as pn
from headway.plans import schedule as sc
from headway.sinks import files, tables
from headway.sources import fixtures as fx

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_no_python_and_bounded_single_partition(spark, name):
    if not os.path.isdir(SF):
        pytest.skip("test data not present")
    plan = _plan(entry.QUERIES[name](spark, SF))
    assert not any(node in plan for node in PYTHON_NODES), name
    # a single-partition exchange may only carry per-slice edge rows (keyed by the slice id)
    # or the partial rows of a global aggregate (one per task)
    for m in re.finditer(r"Exchange SinglePartition[^\n]*\n((?:[^\n]*\n){1,3})", plan):
        below = m.group(1)
        assert "_slice" in below or re.search(r"HashAggregate\(keys=\[\], functions=\[partial_", below), \
            (name, m.group(0))


def test_day_read_prunes_partitions_and_columns(spark, tmp_path):
    path = str(tmp_path / "positions")
    fx.positions_by_date(spark, SF).write.partitionBy("service_date").parquet(path)
    df = pn.two_day_positions(spark.read.parquet(path), fx.SERVICE_DAY).select("trip_id", "timefetch")
    plan = _plan(df)
    assert "PartitionFilters: [" in plan and "service_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    read_schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "vehicle_occupancyStatus" not in read_schema and "timefetch" in read_schema


def test_flagship_has_no_trip_window(spark):
    text = _plan(entry.entry(spark))
    assert "windowspecdefinition(_slice" in text
    assert "windowspecdefinition(trip_id" not in text     # no window keyed by trip alone
    assert "RoundRobin" not in text


def _joins(plan: str) -> int:
    return len(re.findall(r"SortMergeJoin|ShuffledHashJoin|BroadcastHashJoin", plan))


def _pinned_plans(monkeypatch, *modules):
    """The plans of the frames that a query pins, in order."""
    plans, real = [], ordered.pin

    def pin(df):
        plans.append(_plan(df))
        return real(df)

    for module in modules:
        monkeypatch.setattr(module, "pin", pin)
    return plans


@pytest.mark.parametrize("name", ["stop_punctuality", "offsets_last_stop", "arrival_departure_offsets", "segment_delays"])
def test_schedule_join_is_evaluated_once(spark, monkeypatch, name):
    plans = _pinned_plans(monkeypatch, ordered, pn)
    final = _plan(entry.QUERIES[name](spark, SF))
    with_schedule = [p for p in [*plans, final] if "arrival_time_unix" in p and "vehicle_currentStopSequence" in p
                     and re.search(r"(SortMergeJoin|ShuffledHashJoin|BroadcastHashJoin) \[trip_id#\d+L?, vehicle_currentStopSequence", p)]
    assert len(with_schedule) == 1
    # the final plan joins summaries of slices (and, for segments, route shapes) only: nothing of the schedule
    assert with_schedule[0] is not final and _joins(final) <= 2


def test_statistics_read_no_column(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("id", "cast(id as string) as text").write.parquet(path)
    plan = _plan(files.table_stats(spark, path))
    assert "ReadSchema: struct<>" in plan


def test_landed_messages_are_read_once(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "docks_1701442900.json").write_text('{"data": {"stations": [{"id": 5}]}}')
    (raw / "docks_1701442960.json").write_text('{"data": ')
    messages = jobs.landed_messages(spark, str(raw), str(tmp_path / "out"))
    (raw / "docks_1701442900.json").unlink()
    (raw / "docks_1701442960.json").unlink()
    # schema and rows come from the pinned messages: the folder may be gone
    assert "FileScan" not in _plan(messages)
    assert jobs.seen_schema(messages).names == ["data"]
    assert [r.timefetch for r in messages.collect()] == [1701442900]
    assert spark.read.parquet(str(tmp_path / "out_rejects")).first().value == '{"data": '


def test_run_time_filter_reaches_the_stop_times_scan(spark, tmp_path):
    """With Spark's Bloom filter, the day's trips prune the scan of stop times before its exchange."""
    spark.range(20000).selectExpr("cast(id as string) as trip_id", "'S' || id % 50 as service_id").write.parquet(str(tmp_path / "trips"))
    spark.range(100000).selectExpr("cast(id % 20000 as string) as trip_id", "id as stop_sequence", "repeat('x', 60) as pad").write.parquet(
        str(tmp_path / "stop_times"))
    settings = {"spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
                "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
                "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}

    def day_stop_times():
        trips = spark.read.parquet(str(tmp_path / "trips")).where("service_id = 'S7'")
        return sc.filtered_stop_times(spark.read.parquet(str(tmp_path / "stop_times")), trips)

    plain = sorted(map(tuple, day_stop_times().collect()))
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = day_stop_times()
        assert "might_contain" in _plan(df)
        assert sorted(map(tuple, df.collect())) == plain and len(plain) == 2000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_bucketed_tables_are_not_exchanged(spark, tmp_path):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        by_stop = tables.write_bucketed(pn.stop_times_unix(fx.stop_times(spark, SF), fx.SERVICE_DAY), "plan_by_stop",
                                        str(tmp_path / "a"), tables.BY_STOP)
        polls = fx.positions(spark, SF).select(F.col("vehicle_trip_tripId").cast("bigint").alias("trip_id"),
                                               F.col("vehicle_currentStopSequence").alias("stop_sequence"), "id")
        plan = _plan(polls.join(by_stop, ["trip_id", "stop_sequence"]))
        assert plan.count("ENSURE_REQUIREMENTS") == 1 and "SelectedBucketsCount" in plan
        schedule_side = plan[plan.rindex("\n      +- "):]                      # the join's right side
        assert "plan_by_stop" in schedule_side and "Exchange" not in schedule_side
        st = tables.write_bucketed(fx.stop_times(spark, SF), "plan_stop_times", str(tmp_path / "b"), tables.BY_TRIP)
        tr = tables.write_bucketed(fx.trips(spark, SF), "plan_trips", str(tmp_path / "c"), tables.BY_TRIP)
        for joined in (sc.filtered_stop_times(st, tr), st.join(tr, "trip_id", "left")):
            assert "Exchange" not in _plan(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for name in ("plan_by_stop", "plan_stop_times", "plan_trips"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
