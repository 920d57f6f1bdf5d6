"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each reads the driver's tables through ``sources.fixtures`` (so its work grows
with them) and calls the library function that implements the operator.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .functions import labels as lb
from .functions.clock import date_folder
from .plans import bikeshare as bk
from .plans import feeds as fd
from .plans import jobs
from .plans import punctuality as pn
from .plans import schedule as sc
from .plans import static_refresh as sr
from .session import configure, ensure_checkpoint_dir, size_exchanges
from .sinks import files, tables
from .sources import fixtures as fx
from .sources import gtfs
from .streaming import landing

DAY = fx.SERVICE_DAY
CLOCK_CHANGE_DAY = dt.date(2023, 11, 5)
TZ = fx.SERVICE_TZ

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        size_exchanges(spark, sf_dir)
        return fn(spark, sf_dir)
    wrapped.__name__ = fn.__name__
    wrapped.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = wrapped
    return wrapped


def _positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pn.two_day_positions(fx.positions_by_date(spark, sf_dir), DAY)


def _stu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pn.stop_times_unix(fx.stop_times(spark, sf_dir), DAY, TZ)


# ---------------------------------------------------------------- bus punctuality

@query
def stop_times_unix(spark, sf_dir):
    """F1 F2"""
    return _stu(spark, sf_dir)


@query
def two_day_positions(spark, sf_dir):
    """SRC11 U1 P4"""
    return _positions(spark, sf_dir)


@query
def filter_positions(spark, sf_dir):
    """C4 W1 P7 (per-trip change)"""
    return pn.filter_positions(_positions(spark, sf_dir), exact=False)


@query
def filter_positions_exact(spark, sf_dir):
    """W1 exact mode (global change)"""
    return pn.filter_positions(_positions(spark, sf_dir), exact=True)


@query
def positions_on_schedule(spark, sf_dir):
    """J3 P8 P9"""
    return pn.positions_on_schedule(_positions(spark, sf_dir), _stu(spark, sf_dir))


@query
def offsets_stopped(spark, sf_dir):
    """R1"""
    return pn.offsets(_positions(spark, sf_dir), _stu(spark, sf_dir), upto="stopped")


@query
def offsets_in_transit(spark, sf_dir):
    """R2 W2 W3"""
    return pn.offsets(_positions(spark, sf_dir), _stu(spark, sf_dir), upto="in_transit")


@query
def offsets_last_stop(spark, sf_dir):
    """R3 W5 A2"""
    return pn.offsets(_positions(spark, sf_dir), _stu(spark, sf_dir), upto="last_stop")


@query
def arrival_departure_offsets(spark, sf_dir):
    """W4 A1"""
    return pn.arrival_departure_offsets(_positions(spark, sf_dir), _stu(spark, sf_dir))


@query
def stop_punctuality(spark, sf_dir):
    """C5 J4 (flagship)"""
    return pn.stop_punctuality(_positions(spark, sf_dir), fx.stop_times(spark, sf_dir), DAY, TZ)


@query
def stop_punctuality_per_trip(spark, sf_dir):
    """C5 with W1 compared within each trip (the intent) instead of across trip borders"""
    return pn.stop_punctuality(_positions(spark, sf_dir), fx.stop_times(spark, sf_dir), DAY, TZ, exact=False)


@query
def segment_deltas(spark, sf_dir):
    """W7 P5"""
    return pn.segment_deltas(stop_punctuality(spark, sf_dir))


@query
def route_shape_map(spark, sf_dir):
    """A3"""
    return pn.route_shape_map(fx.trips(spark, sf_dir))


@query
def segment_delays(spark, sf_dir):
    """C6 J9"""
    return pn.segment_delays(stop_punctuality(spark, sf_dir), fx.trips(spark, sf_dir))


# ---------------------------------------------------------------- bus schedule

def _day_schedule(spark, sf_dir):
    return sc.filter_service_day(fx.calendar(spark, sf_dir), fx.trips(spark, sf_dir),
                                 fx.stop_times(spark, sf_dir), DAY)


@query
def active_services(spark, sf_dir):
    """P10 F6 F7"""
    return sc.active_services(fx.calendar(spark, sf_dir), DAY)


@query
def services_by_day(spark, sf_dir):
    """P10 multi-day form: services running on each service date present in the polls"""
    return sc.services_by_day(fx.calendar(spark, sf_dir), fx.poll_dates(spark, sf_dir))


@query
def filtered_trips(spark, sf_dir):
    """J1"""
    return _day_schedule(spark, sf_dir)[1]


@query
def filtered_stop_times(spark, sf_dir):
    """J2 A5"""
    return _day_schedule(spark, sf_dir)[2]


@query
def stop_times_unix_wall(spark, sf_dir):
    """F3"""
    return sc.stop_times_wall_unix(fx.stop_times(spark, sf_dir), DAY, TZ)


@query
def stop_times_unix_wall_strict(spark, sf_dir):
    """F3 strict: raises on non-existent or ambiguous local times (none on this service day)"""
    return sc.stop_times_wall_unix(fx.stop_times(spark, sf_dir), DAY, TZ, strict=True)


@query
def stop_times_unix_clock_change(spark, sf_dir):
    """F1 F2 on the day the clocks go back: 24 h a day, whatever its length"""
    return pn.stop_times_unix(fx.stop_times(spark, sf_dir), CLOCK_CHANGE_DAY, TZ)


@query
def stop_times_unix_wall_clock_change(spark, sf_dir):
    """F3 on the day the clocks go back: the wall clock of the next day"""
    return sc.stop_times_wall_unix(fx.stop_times(spark, sf_dir), CLOCK_CHANGE_DAY, TZ)


@query
def daily_stops_info(spark, sf_dir):
    """C2 J6-J8 F4 F5 P6"""
    _, day_trips, day_stop_times = _day_schedule(spark, sf_dir)
    return sc.daily_stops_info(day_stop_times, day_trips, fx.stops(spark, sf_dir),
                               fx.routes(spark, sf_dir), DAY, TZ)


# ---------------------------------------------------------------- feeds

def _vehicle_messages(spark, sf_dir):
    """fx positions as decoded feed messages; a message holds the polls of <= 64 trips."""
    p = fx.positions(spark, sf_dir)
    entity = F.struct(
        F.col("id"),
        F.struct(F.struct(F.col("vehicle_trip_tripId").alias("tripId"),
                          F.col("vehicle_trip_routeId").alias("routeId")).alias("trip"),
                 F.struct(F.col("vehicle_vehicle_id").alias("id")).alias("vehicle"),
                 F.col("vehicle_timestamp").alias("timestamp"),
                 F.col("vehicle_currentStatus").alias("currentStatus"),
                 F.col("vehicle_currentStopSequence").alias("currentStopSequence"),
                 F.col("vehicle_occupancyStatus").alias("occupancyStatus")).alias("vehicle"))
    chunk = F.floor(F.col("vehicle_trip_tripId").cast("bigint") / 64)
    entities = p.select("poll_day", chunk.alias("chunk"), entity.alias("e"))
    schema = entities.schema["e"].dataType
    messages = (entities.groupBy("poll_day", "chunk")
                .agg(F.to_json(F.struct(F.collect_list("e").alias("entity"))).alias("value")))
    return messages, schema


@query
def feed_flatten(spark, sf_dir):
    """SRC2 F11 O2"""
    messages, schema = _vehicle_messages(spark, sf_dir)
    return fd.flatten_feed(messages, schema)


@query
def trip_updates_flatten(spark, sf_dir):
    """SRC3: arrays stay arrays; compared through their size and sequence sum per trip"""
    st = fx.stop_times(spark, sf_dir)
    update = F.struct(F.col("stop_sequence").alias("stopSequence"),
                      F.col("stop_id").cast("string").alias("stopId"))
    # an entity carries at most 64 stop updates of one trip; a message at most 64 trip ids
    ents = (st.groupBy("trip_id", F.floor(F.col("stop_sequence") / 64).alias("part"))
            .agg(F.collect_list(update).alias("u"))
            .select(F.floor(F.col("trip_id") / 64).alias("chunk"), F.struct(
                F.concat_ws("-", F.col("trip_id").cast("string"), F.col("part").cast("string")).alias("id"),
                F.struct(F.struct(F.col("trip_id").cast("string").alias("tripId")).alias("trip"),
                         F.col("u").alias("stopTimeUpdate")).alias("tripUpdate")).alias("e")))
    schema = ents.schema["e"].dataType
    messages = ents.groupBy("chunk").agg(F.to_json(F.struct(F.collect_list("e").alias("entity"))).alias("value"))
    flat = fd.flatten_feed(messages, schema)
    arr = F.col("tripUpdate_stopTimeUpdate")
    return (flat.groupBy("tripUpdate_trip_tripId")
            .agg(F.sum(F.size(arr)).alias("stop_updates"),
                 F.sum(F.aggregate(arr, F.lit(0).cast("bigint"), lambda acc, x: acc + x["stopSequence"]))
                 .alias("stop_sequence_sum")))


@query
def station_snapshot(spark, sf_dir):
    """C8 F12"""
    s = fx.station_status(spark, sf_dir)
    station = F.struct("station_id", "num_bikes_available", "is_renting", "last_reported")
    fields = s.select(station.alias("x")).schema["x"].dataType
    # one status document per poll, at most 1000 stations each
    docs = (s.groupBy(F.floor(F.col("last_reported") / 1000).alias("poll"))
            .agg(F.to_json(F.struct(F.struct(F.collect_list(station).alias("stations")).alias("data")))
                 .alias("value")))
    return fd.station_snapshot(docs, fields)


@query
def merge_drifted_polls(spark, sf_dir):
    """Day-0 polls lack occupancy, day-1 polls lack the vehicle id"""
    p = fx.positions(spark, sf_dir)
    day0 = p.where(F.col("poll_day") == 0).drop("vehicle_occupancyStatus")
    day1 = p.where(F.col("poll_day") == 1).drop("vehicle_vehicle_id")
    return fd.merge_polls([day0, day1])


# ---------------------------------------------------------------- bike share

def _bike_trips(spark, sf_dir):
    return bk.normalise_trip_columns(fx.bike_csv(spark, sf_dir))


@query
def bike_trip_durations(spark, sf_dir):
    """F14 P2"""
    return bk.bike_trip_durations(_bike_trips(spark, sf_dir))


@query
def high_water_increment(spark, sf_dir):
    """stored = trips up to the mark; increment = trips after the stored maximum"""
    trips = bk.bike_trip_durations(_bike_trips(spark, sf_dir))
    stored = trips.where(F.col("startTimeMs") <= fx.HIGH_WATER_MARK)
    return bk.high_water_increment(trips, stored)


@query
def station_locations(spark, sf_dir):
    """U3 A4"""
    return bk.station_locations(_bike_trips(spark, sf_dir))


@query
def stations_insert_if_absent(spark, sf_dir):
    """SNK5 J11"""
    return bk.stations_insert_if_absent(bk.station_locations(_bike_trips(spark, sf_dir)),
                                        fx.stored_stations(spark, sf_dir))


@query
def mean_trip_duration(spark, sf_dir):
    """A8"""
    return bk.mean_trip_duration(bk.bike_trip_durations(_bike_trips(spark, sf_dir)))


@query
def catalogue_links(spark, sf_dir):
    """F13 P12"""
    return bk.catalogue_links(fx.catalogue(spark, sf_dir), fx.CDN)


@query
def new_catalogue_entries(spark, sf_dir):
    """C9 J10"""
    return bk.new_catalogue_entries(bk.catalogue_links(fx.catalogue(spark, sf_dir), fx.CDN),
                                    fx.loaded_urls(spark, sf_dir))


@query
def trusted_urls(spark, sf_dir):
    """F15"""
    pages = fx.table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", lb.trusted_url(F.col("url"), fx.CDN_ORIGIN).alias("trusted_url"))


@query
def readable_sizes(spark, sf_dir):
    """F16"""
    docs = fx.table(spark, sf_dir, "documents")
    return docs.select("doc_id", lb.readable_size(F.col("n_chars") * 1009).alias("size"))


@query
def poll_times_from_names(spark, sf_dir):
    """SRC7: poll epoch of a file name, null where the name has none"""
    e = fx.table(spark, sf_dir, "events")
    name = F.concat(F.lit("feed/polls"), F.when(F.col("event_id") % 7 == 0, F.lit("-")).otherwise(F.lit("_")),
                    (F.lit(1701400000) + F.col("event_id")).cast("string"), F.lit(".parquet"))
    return e.select("event_id", fd.poll_time_from_path(name).alias("timefetch"))


@query
def day_partitions(spark, sf_dir):
    """SNK1 SNK2 SNK8: polls written by day with a file count fixed by the rows (two at least), a day rewritten, and read again"""
    folder = f"{ensure_checkpoint_dir(spark)}/day-partitions-{uuid.uuid4().hex}"
    polls = fx.positions_by_date(spark, sf_dir)
    rows = fx.table(spark, sf_dir, "lineitem").count()           # footers only; a day has no more polls than these
    files.write_day_partitioned(polls, folder, files_per_day=files.file_count(rows, at_least=2), salt_cols=("id",))
    files.write_day_partitioned(polls.where(F.col("service_date") == fx.SERVICE_DAY), folder)
    return gtfs.read_day(spark, folder, DAY, next_day=True).groupBy("service_date").agg(
        F.count(F.lit(1)).alias("polls"), F.sum("timefetch").alias("time_sum"))


# ---------------------------------------------------------------- jobs on files: written to a scratch folder, run, read back

def _scratch(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


POLL_SCHEMA = StructType([StructField("timefetch", LongType()), StructField("id", StringType())])


def _drifted(spark, sf_dir, folder_of) -> list[str]:
    """Polls by day as Parquet in the folders of their days: odd trips lack the occupancy, even ones the vehicle."""
    p = fx.positions(spark, sf_dir)
    odd = F.col("vehicle_trip_tripId").cast("bigint") % 2 == 1
    folders = []
    for k in (0, 1):
        day = p.where(F.col("poll_day") == k).drop("poll_day")
        folder = folder_of(DAY + dt.timedelta(days=k))
        day.where(odd).drop("vehicle_occupancyStatus").write.mode("append").parquet(folder)
        day.where(~odd).drop("vehicle_vehicle_id").write.mode("append").parquet(folder)
        folders.append(folder)
    return folders


@query
def merge_day(spark, sf_dir):
    """C3 SRC6 SRC8 A7 U2 F8 F9: two days of poll files whose columns differ, merged by the nightly job and read again"""
    base = _scratch(spark, "merge-day")
    _drifted(spark, sf_dir, lambda d: f"{base}/landing/{date_folder(d)}")
    for run in (DAY + dt.timedelta(days=1), DAY + dt.timedelta(days=2)):         # runs the morning after
        jobs.merge_day_job(spark, f"{base}/landing", f"{base}/days", files.run_date(run, TZ, -1), POLL_SCHEMA)
    return gtfs.read_day(spark, f"{base}/days", DAY, next_day=True)


@query
def landed_stream(spark, sf_dir):
    """STR1 SRC7 P15: the same poll files picked up by the stream, read again with all their columns"""
    base = _scratch(spark, "landed-stream")
    _drifted(spark, sf_dir, lambda d: f"{base}/landing/{date_folder(d)}")
    landing.positions_landing_stream(spark, f"{base}/landing", f"{base}/days", f"{base}/state", POLL_SCHEMA, TZ).awaitTermination()
    return spark.read.option("mergeSchema", True).parquet(f"{base}/days").drop("load_batch")


def _bucketed(spark: SparkSession, df: DataFrame, name: str, keys) -> DataFrame:
    table = f"{name}_{uuid.uuid4().hex}"
    return tables.write_bucketed(df, table, _scratch(spark, table), keys)


@query
def positions_on_bucketed_schedule(spark, sf_dir):
    """J3 J4 with the schedule stored in buckets of its key: its side of the join is not exchanged"""
    schedule = _bucketed(spark, _stu(spark, sf_dir), "stop_times", tables.BY_STOP)
    return pn.positions_on_schedule(_positions(spark, sf_dir), schedule)


@query
def daily_stops_info_bucketed(spark, sf_dir):
    """C2 J2 J6 with trips and stop times stored in buckets by trip: neither join by trip has an exchange"""
    trips = _bucketed(spark, fx.trips(spark, sf_dir), "trips", tables.BY_TRIP)
    stop_times = _bucketed(spark, fx.stop_times(spark, sf_dir), "stop_times", tables.BY_TRIP)
    day_trips = sc.filtered_trips(sc.active_services(fx.calendar(spark, sf_dir), DAY), trips)
    return sc.daily_stops_info(sc.filtered_stop_times(stop_times, day_trips), day_trips,
                               fx.stops(spark, sf_dir), fx.routes(spark, sf_dir), DAY, TZ)


@query
def gtfs_table(spark, sf_dir):
    """SRC1 SRC10: a text table whose columns are in another order, read by its header with declared types"""
    folder = _scratch(spark, "gtfs-table")
    st = fx.stop_times(spark, sf_dir)
    st.select(*reversed(st.columns)).write.option("header", True).csv(folder)
    return gtfs.read_gtfs_table(spark, folder, "stop_times")


@query
def static_tables(spark, sf_dir):
    """C12 SRC1 SNK7: a feed of text tables converted when it is newer than the stored one, and not again"""
    base = _scratch(spark, "static")
    fx.calendar(spark, sf_dir).write.option("header", True).csv(f"{base}/feed/calendar.txt")
    fx.routes(spark, sf_dir).write.option("header", True).csv(f"{base}/feed/routes.txt")
    for modified in ("Fri, 01 Dec 2023 10:00:00 GMT", "Thu, 30 Nov 2023 10:00:00 GMT"):
        sr.refresh_static(spark, f"{base}/feed", f"{base}/static", modified, f"{base}/ledger")
        fx.calendar(spark, sf_dir).where(F.lit(False)).write.mode("overwrite").option("header", True).csv(f"{base}/feed/calendar.txt")
    return spark.read.parquet(f"{base}/static/calendar")


@query
def segments_indexed(spark, sf_dir):
    """SNK3 SRC9 O5 C6: the day's segments stored with their index, written twice, read again"""
    base = _scratch(spark, "segments")
    stop_punctuality(spark, sf_dir).withColumn("service_date", F.lit(DAY)).write.partitionBy("service_date").parquet(f"{base}/stops")
    fx.trips(spark, sf_dir).write.parquet(f"{base}/static/trips")
    for _ in range(2):
        jobs.segments_job(spark, f"{base}/stops", f"{base}/static", f"{base}/segments", DAY, with_index=True)
    return gtfs.read_day_required(spark, f"{base}/segments", DAY).drop("service_date")


def _bike_history(spark, sf_dir) -> str:
    """Two catalogue entries, given latest first: the second file repeats the first one's trips and adds the later ones."""
    base = _scratch(spark, "bike-history")
    rides = fx.bike_csv(spark, sf_dir)
    rides.where(F.col("STARTTIMEMS") <= fx.HIGH_WATER_MARK).write.option("header", True).csv(f"{base}/csv/first")
    rides.select(*reversed(rides.columns)).write.option("header", True).csv(f"{base}/csv/second")
    entries = spark.createDataFrame([(2024, "https://cdn.example.com/rides/second.zip"), (2019, "https://cdn.example.com/rides/old.zip"),
                                     (2023, "http://elsewhere.example/rides/first.zip?x=1")], "year int, url string")
    paths = {f"{fx.CDN_ORIGIN}/rides/{n}.zip": gtfs.list_files(spark, f"{base}/csv/{n}", "*.csv") for n in ("first", "second")}
    jobs.historical_load(spark, entries, paths, f"{base}/trips", f"{base}/stations", f"{base}/ledger", fx.CDN_ORIGIN)
    return base


@query
def bike_history_trips(spark, sf_dir):
    """C10 C11 SRC5 P13 P11 SNK4 O4: the trips that a load of two overlapping files in year order stores"""
    return spark.read.parquet(f"{_bike_history(spark, sf_dir)}/trips").select(*bk.TRIP_COLUMNS)


@query
def bike_history_ledger(spark, sf_dir):
    """C11 SNK5 SNK6 O4: the ledger of that load, with the trips and stations each entry added"""
    base = _bike_history(spark, sf_dir)

    def added(table: str) -> DataFrame:
        return spark.read.parquet(f"{base}/{table}").groupBy(files.LOAD).agg(F.count(F.lit(1)).alias(table))

    return (spark.read.parquet(f"{base}/ledger").join(added("trips"), files.LOAD, "left").join(added("stations"), files.LOAD, "left")
            .select("year", "url", F.coalesce("trips", F.lit(0)).alias("trips"), F.coalesce("stations", F.lit(0)).alias("stations")))


@query
def bike_stream(spark, sf_dir):
    """STR2: trip files of two column orders picked up by the stream; the trips it stores"""
    base = _scratch(spark, "bike-stream")
    rides = fx.bike_csv(spark, sf_dir)
    early = F.col("STARTTIMEMS") <= fx.HIGH_WATER_MARK
    rides.where(early).write.option("header", True).mode("append").csv(f"{base}/csv")
    rides.where(~early).select(*reversed(rides.columns)).write.option("header", True).mode("append").csv(f"{base}/csv")
    landing.bike_trips_stream(spark, f"{base}/csv", f"{base}/trips", f"{base}/stations", f"{base}/state").awaitTermination()
    return spark.read.parquet(f"{base}/trips").select(*bk.TRIP_COLUMNS)


@query
def compacted_day(spark, sf_dir):
    """SNK1 SNK8: half-hourly polls landed one folder each, folded into day files, one poll landed again and folded again"""
    base = _scratch(spark, "compacted-day")
    half_hour = (F.floor(F.col("timefetch") / 1800) * 1800).cast("bigint")
    polls = fx.positions(spark, sf_dir).where(F.col("poll_day") == 0).select(
        "id", "vehicle_occupancyStatus", half_hour.alias("timefetch")).where(jobs.poll_date(F.col("timefetch"), TZ) == F.lit(DAY))
    jobs.land_rows(polls, f"{base}/landed", TZ)
    jobs.compact_landed_day(spark, f"{base}/landed", f"{base}/days", DAY)
    noon = fx.LOCAL_MIDNIGHT + 12 * 3600
    jobs.land_rows(polls.where(F.col("timefetch") == noon).withColumn("vehicle_occupancyStatus", F.lit("EMPTY")), f"{base}/landed", TZ)
    jobs.compact_landed_day(spark, f"{base}/landed", f"{base}/days", DAY)
    return gtfs.read_day(spark, f"{base}/days", DAY).groupBy("timefetch", "vehicle_occupancyStatus").agg(F.count(F.lit(1)).alias("polls"))


@query
def table_statistics(spark, sf_dir):
    """SNK9 F16: rows of the poll table from its footers, and whether bytes were found (they differ from run to run)"""
    folder = _scratch(spark, "statistics")
    fx.positions_by_date(spark, sf_dir).write.partitionBy("service_date").parquet(folder)
    return files.table_stats(spark, folder).select(
        "rows", (F.col("storage_bytes") > 0).alias("has_bytes"),
        (F.abs(F.col("mean_row_bytes") * F.col("rows") - F.col("storage_bytes")) < 1).alias("mean_fits"),
        F.col("size").rlike(r"^[0-9]+\.[0-9] ([KMGTPEZ]i)?B$").alias("size_reads"))


@query
def year_layouts(spark, sf_dir):
    """P16"""
    return bk.year_layouts(fx.page_urls(spark, sf_dir))


# ---------------------------------------------------------------- static refresh

@query
def freshness_gate(spark, sf_dir):
    """SNK7"""
    v = fx.source_versions(spark, sf_dir)
    stored = (v.where(F.col("stored_last_modified").isNotNull())
              .select("source_id", F.col("stored_last_modified").alias("last_modified")))
    return sr.freshness_gate(v.select("source_id", "last_modified"), stored)
