"""Bus schedule of one service day: active services, trips and stop times (C1), stop info.

Only ``calendar`` decides which services run (no exception-date table is read).
All joins are equi-joins left to Catalyst/AQE: dimension sides become
broadcasts when their measured size allows it, sort-merge otherwise.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from ..functions.clock import (DEFAULT_TZ, as_date, weekday_name, weekday_name_col,
                               wall_clock_to_epoch, yyyymmdd_to_date)
from ..functions.labels import route_info

WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]

DAILY_STOPS_INFO_COLUMNS = ["route_id", "route_info", "trip_id", "shape_id", "wheelchair_accessible",
                            "arrival_time_unix", "stop_id", "stop_name", "stop_lat", "stop_lon",
                            "wheelchair_boarding"]


def _calendar_dates(calendar: DataFrame) -> DataFrame:
    """parse ``start_date``/``end_date`` unless they are already dates."""
    types = dict((f.name, f.dataType) for f in calendar.schema.fields)
    return calendar.withColumns({
        c: yyyymmdd_to_date(F.col(c), isinstance(types[c], DateType)) for c in ("start_date", "end_date")})


def active_services(calendar: DataFrame, day: str | dt.date) -> DataFrame:
    """P10 + F6 + F7: services whose date range holds ``day`` and whose weekday flag is 1."""
    d = as_date(day)
    cal = _calendar_dates(calendar)
    return (cal.where((F.col("start_date") <= F.lit(d)) & (F.col("end_date") >= F.lit(d))
                      & (F.col(weekday_name(d)) == 1))
            .select("service_id"))


def services_by_day(calendar: DataFrame, days: DataFrame) -> DataFrame:
    """P10 multi-day form: (service_date, service_id) for every day in ``days.service_date``.

    Each calendar row is expanded to the days of its own date range (a feed's
    validity span, so bounded) and matched to ``days`` with an equi-join.
    """
    cal = _calendar_dates(calendar)
    flags = F.create_map(*[x for w in WEEKDAYS for x in (F.lit(w), F.col(w))])
    running = (cal.select("service_id", flags.alias("flags"),
                          F.explode(F.sequence("start_date", "end_date")).alias("service_date"))
               .where(F.element_at("flags", weekday_name_col(F.col("service_date"))) == 1))
    return (days.select("service_date").join(running, "service_date")
            .select("service_date", "service_id"))


def filtered_trips(active: DataFrame, trips: DataFrame) -> DataFrame:
    """Trips of the active services (a repeated service id repeats its trips)."""
    return active.join(trips, "service_id", "inner")


def filtered_stop_times(stop_times: DataFrame, trips_of_day: DataFrame) -> DataFrame:
    """J2 + A5: stop times of the day's trips; a semi join, no id list on the driver."""
    return stop_times.join(trips_of_day.select("trip_id"), "trip_id", "left_semi")


def filter_service_day(calendar: DataFrame, trips: DataFrame, stop_times: DataFrame,
                       day: str | dt.date) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(active services, filtered trips, filtered stop times) of one service day."""
    active = active_services(calendar, day)
    day_trips = filtered_trips(active, trips)
    return active, day_trips, filtered_stop_times(stop_times, day_trips)


def stop_times_wall_unix(stop_times: DataFrame, day: str | dt.date, tz: str = DEFAULT_TZ,
                         strict: bool = False) -> DataFrame:
    """F3 applied to a schedule: ``arrival_time_unix`` in the wall-clock form."""
    return stop_times.withColumn("arrival_time_unix",
                                 wall_clock_to_epoch(F.col("arrival_time"), day, tz, strict))


def daily_stops_info(stop_times: DataFrame, trips: DataFrame, stops: DataFrame, routes: DataFrame,
                     day: str | dt.date, tz: str = DEFAULT_TZ, strict: bool = False) -> DataFrame:
    """The day's stop times joined (left) to trips, stops and routes, with a route label."""
    st = (stop_times_wall_unix(stop_times, day, tz, strict)
          .withColumn("stop_id", F.col("stop_id").cast("string")))                          # P6
    sp = stops.select(F.col("stop_id").cast("string").alias("stop_id"), "stop_name", "stop_lat",
                      "stop_lon", "wheelchair_boarding")
    tr = trips.select("trip_id", "route_id", "trip_headsign", "direction_id", "shape_id",
                      "wheelchair_accessible")
    merged = (st.join(tr, "trip_id", "left")                                               # J6
              .join(sp, "stop_id", "left")                                                 # J7
              .join(routes.select("route_id", "route_long_name"), "route_id", "left"))     # J8
    return (merged.withColumn("route_info", route_info(F.col("route_id"), F.col("route_long_name"),
                                                       F.col("trip_headsign")))
            .select(*DAILY_STOPS_INFO_COLUMNS))
