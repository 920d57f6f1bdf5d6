"""Path-level pipeline on sf0.001-derived tables: C1 -> C2 -> C5 -> C6, then a rerun."""

import os

import pytest

from headway.plans import jobs
from headway.plans import punctuality as pn
from headway.registry import QUERIES
from headway.sources import fixtures as fx

SF = "/root/testdata/sf0.001"
DAY = fx.SERVICE_DAY


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    if not os.path.isdir(SF):
        pytest.skip("test data not present")
    root = str(tmp_path_factory.mktemp("pipeline"))
    static = os.path.join(root, "static")
    for name, df in [("calendar", fx.calendar(spark, SF)), ("trips", fx.trips(spark, SF)),
                     ("stop_times", fx.stop_times(spark, SF)), ("stops", fx.stops(spark, SF)),
                     ("routes", fx.routes(spark, SF))]:
        df.write.parquet(os.path.join(static, name))
    positions = os.path.join(root, "positions")
    fx.positions_by_date(spark, SF).write.partitionBy("service_date").parquet(positions)
    return root, static, positions


def test_pipeline(spark, layout):
    root, static, positions = layout
    daily = os.path.join(root, "daily")
    jobs.filter_service_day_job(spark, static, daily, DAY)
    jobs.daily_stops_info_job(spark, static, daily, daily, DAY)
    info = spark.read.parquet(os.path.join(daily, "daily_stops_info"))
    assert info.count() == QUERIES["daily_stops_info"](spark, SF).count()

    data_stops = os.path.join(root, "data_stops")
    jobs.stop_punctuality_job(spark, positions, daily, data_stops, DAY)
    got = spark.read.parquet(data_stops).drop("service_date")
    # the path job equals the same plan run on in-memory inputs (C1 output as the schedule)
    want = pn.stop_punctuality(QUERIES["two_day_positions"](spark, SF), QUERIES["filtered_stop_times"](spark, SF),
                               DAY, fx.SERVICE_TZ)
    n_day = got.count()
    assert n_day == want.count() > 0
    assert got.exceptAll(want.select(*got.columns)).count() == 0

    segments = os.path.join(root, "segments")
    jobs.segments_job(spark, data_stops, static, segments, DAY, with_index=True)
    seg = spark.read.parquet(segments)
    n = seg.count()
    assert n > 0 and sorted(r["index"] for r in seg.select("index").collect()) == list(range(n))

    # rerunning C5 replaces the day's partition
    jobs.stop_punctuality_job(spark, positions, daily, data_stops, DAY)
    assert spark.read.parquet(data_stops).count() == n_day
