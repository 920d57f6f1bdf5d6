"""Service-day clocks, pinned values and clock changes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from headway.functions import clock


def _one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first().v


def test_fixed_day_form_golden_values(spark):
    # 23:59:59 and 24:30:00 on 2023-12-01 in Montreal
    v1 = _one(spark, clock.service_clock_to_epoch(F.lit("23:59:59"), "20231201"))
    v2 = _one(spark, clock.service_clock_to_epoch(F.lit("24:30:00"), "20231201"))
    assert (v1, v2) == (1701493199, 1701495000)


def test_wall_clock_form_next_day_midnight(spark):
    # 24:00:00 on 2023-01-01 is local midnight of 2023-01-02 (UTC-5)
    v = _one(spark, clock.wall_clock_to_epoch(F.lit("24:00:00"), "20230101"))
    assert v == int(dt.datetime(2023, 1, 2, 5, 0, tzinfo=dt.timezone.utc).timestamp())


def test_forms_differ_across_the_autumn_change(spark):
    # 27:30:00 on 2023-11-04: fixed 86 400 s days vs wall clock of 2023-11-05
    fixed = _one(spark, clock.service_clock_to_epoch(F.lit("27:30:00"), "2023-11-04"))
    wall = _one(spark, clock.wall_clock_to_epoch(F.lit("27:30:00"), "2023-11-04"))
    assert fixed == 1699169400
    assert wall == 1699173000


def test_more_than_one_extra_day(spark):
    v = _one(spark, clock.service_clock_to_epoch(F.lit("49:00:00"), "20231201"))
    assert v == 1701406800 + 49 * 3600


def test_lenient_gap_and_overlap(spark):
    gap = _one(spark, clock.wall_clock_to_epoch(F.lit("02:30:00"), "2023-03-12"))
    overlap = _one(spark, clock.wall_clock_to_epoch(F.lit("01:30:00"), "2023-11-05"))
    assert gap == 1678606200
    assert overlap == 1699162200


@pytest.mark.parametrize("clock_text,day", [("02:30:00", "2023-03-12"), ("01:30:00", "2023-11-05")])
def test_strict_raises_on_gap_and_overlap(spark, clock_text, day):
    with pytest.raises(Exception):
        _one(spark, clock.wall_clock_to_epoch(F.lit(clock_text), day, strict=True))


def test_strict_accepts_ordinary_times(spark):
    v = _one(spark, clock.wall_clock_to_epoch(F.lit("25:10:00"), "20231201", strict=True))
    assert v == 1701406800 + 25 * 3600 + 600


def test_bad_clock_text_raises(spark):
    with pytest.raises(Exception):
        _one(spark, clock.service_clock_to_epoch(F.lit("ab:00:00"), "20231201"))


def test_dates_and_weekdays(spark):
    assert clock.weekday_name("20230101") == "sunday"
    assert clock.date_folder("2023-12-01") == "2023/12/01"
    assert clock.shifted_day("20230101", -2) == dt.date(2022, 12, 30)
    v = _one(spark, clock.yyyymmdd_to_date(F.lit(20231201)))
    assert v == dt.date(2023, 12, 1)
