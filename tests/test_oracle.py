"""Every registered query against its DuckDB twin on sf0.001 (the driver does the same at sf0.01)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import compare  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def report(spark):
    if not os.path.isdir(SF):
        pytest.skip("test data not present")
    return compare(spark, SF, sorted(entry.QUERIES))


def test_every_query_has_an_oracle():
    assert set(entry.QUERIES) == set(entry.oracle_sql()) - set(entry.LLM_ORACLE)


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query_matches_oracle(report, name):
    r = report[name]
    assert r["ok"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["trip_id", "arrival_time", "stop_id", "stop_sequence", "arrival_time_unix", "vehicleID",
                          "Current_Occupancy", "offset", "routeId", "arrival_time_offset", "departure_time_offset"]
    assert df.count() > 0
