"""Path-level jobs: read landed tables, run a plan, write the result.

Each job takes the *service date it processes*; ``sinks.files.run_date``
applies the reference's scheduling shifts (merge -1 day, analyse -2 days).
Outputs are date-partitioned Parquet rewritten per day (dynamic partition
overwrite), so rerunning a day replaces exactly that day.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions.clock import DEFAULT_TZ, as_date, date_folder
from ..operators.ordered import checkpointed, global_row_number, slice_by_order
from ..sinks import files
from ..sources import census, gtfs
from . import bikeshare as bk
from . import feeds as fd
from . import punctuality as pn
from . import schedule as sc

DATE_COL = "service_date"


def _with_day(df: DataFrame, day: dt.date) -> DataFrame:
    return df.withColumn(DATE_COL, F.lit(day))


def _static(spark: SparkSession, static_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{static_dir.rstrip('/')}/{table}")


# ---------------------------------------------------------------- schedule

def filter_service_day_job(spark: SparkSession, static_dir: str, out_dir: str, day) -> None:
    """``filtered_trips`` and ``filtered_stop_times`` of one day, partitioned by day."""
    d = as_date(day)
    _, trips, stop_times = sc.filter_service_day(_static(spark, static_dir, "calendar"),
                                                 _static(spark, static_dir, "trips"),
                                                 _static(spark, static_dir, "stop_times"), d)
    files.write_day_partitioned(_with_day(trips, d), f"{out_dir}/filtered_trips", compression="snappy")
    files.write_day_partitioned(_with_day(stop_times, d), f"{out_dir}/filtered_stop_times",
                                compression="snappy")


def daily_stops_info_job(spark: SparkSession, static_dir: str, daily_dir: str, out_dir: str, day,
                         tz: str = DEFAULT_TZ, strict: bool = False) -> None:
    """Stop information of one day from its filtered schedule."""
    d = as_date(day)
    trips = gtfs.read_day(spark, f"{daily_dir}/filtered_trips", d).drop(DATE_COL)
    stop_times = gtfs.read_day(spark, f"{daily_dir}/filtered_stop_times", d).drop(DATE_COL)
    info = sc.daily_stops_info(stop_times, trips, _static(spark, static_dir, "stops"),
                               _static(spark, static_dir, "routes"), d, tz, strict)
    files.write_day_partitioned(_with_day(info, d), f"{out_dir}/daily_stops_info", compression="snappy")


# ---------------------------------------------------------------- vehicle positions

def merge_day_job(spark: SparkSession, landing_dir: str, out_dir: str, day, schema: StructType,
                  tz: str = DEFAULT_TZ, files_per_day: int | None = None) -> None:
    """Every poll file under ``<landing>/YYYY/MM/DD/`` -> one compacted gzip day partition.

    Files are grouped by schema from their footers, in a number of jobs that does
    not grow with the files, and united by name (A7, U2, P15; ``read_polls``).
    ``timefetch`` comes from the file name when the file has none (SRC7).  Files
    without the Parquet magic and rows without a poll time go to
    ``<out_dir>_rejects``; any other damage fails the job.
    """
    d = as_date(day)
    folder = f"{landing_dir.rstrip('/')}/{date_folder(d)}"
    groups, bad = census.parquet_census(spark, folder)
    polls = read_polls(spark, groups, schema)
    untimed = fd.conform_polls(polls.withColumn("path", F.col("file_path"))).where(F.col("timefetch").isNull())
    rejects = bad.select("path", F.lit("not a Parquet file").alias("reason"), F.col("length").alias("n")).unionByName(
        untimed.groupBy("path").agg(F.count(F.lit(1)).alias("n")).withColumn("reason", F.lit("rows without a poll time")))
    files.write_rejects(checkpointed(rejects), f"{out_dir.rstrip('/')}_rejects", d.isoformat())
    merged = fd.conform_polls(polls).where(F.col("timefetch").isNotNull())
    files.write_day_partitioned(_with_day(merged, d), out_dir, files_per_day=files_per_day)


def read_polls(spark: SparkSession, groups: list[tuple[StructType, list[str]]], schema: StructType) -> DataFrame:
    """U2 + P15: the files of a census as one frame with their ``file_path``.

    ``schema`` gives the types of the columns it names.  Other columns keep the
    files' type, or become text if it differs between files; a column that some
    files lack is null there.
    """
    declared = {f.name: f for f in schema.fields}
    found: dict[str, set[str]] = {}
    for own, _ in groups:
        for f in own.fields:
            found.setdefault(f.name, set()).add(f.dataType.simpleString())
    mixed = {name for name, types in found.items() if name not in declared and len(types) > 1}
    frames = [spark.createDataFrame([], StructType([*schema.fields, StructField("file_path", StringType())]))]
    for own, paths in groups:
        types = StructType([declared.get(f.name, f) for f in own.fields])
        rows = spark.read.schema(types).parquet(*paths).withColumn("file_path", F.col("_metadata.file_path"))
        frames.append(rows.withColumns({c: F.col(f"`{c}`").cast("string") for c in own.names if c in mixed}))
    return fd.merge_polls(frames)


def stop_punctuality_job(spark: SparkSession, positions_dir: str, daily_dir: str, out_dir: str, day,
                         tz: str = DEFAULT_TZ, exact: bool = True) -> None:
    """``data_stops`` of one service day (polls of that day and the next)."""
    d = as_date(day)
    positions = pn.two_day_positions(spark.read.parquet(positions_dir), d)
    stop_times = gtfs.read_day(spark, f"{daily_dir}/filtered_stop_times", d).drop(DATE_COL)
    result = pn.stop_punctuality(positions, stop_times, d, tz, exact)
    files.write_day_partitioned(_with_day(result, d), out_dir, compression="snappy")


def segments_job(spark: SparkSession, data_stops_dir: str, static_dir: str, out_dir: str, day,
                 with_index: bool = False) -> None:
    """C6 + SNK3: segment rows of one day; a rerun replaces that day.

    ``with_index`` adds the 0-based row position in (trip, arrival) order,
    like the index the reference stores with each inserted row.
    """
    d = as_date(day)
    data_stops = gtfs.read_day_required(spark, data_stops_dir, d).drop(DATE_COL)
    seg = pn.segment_delays(data_stops, _static(spark, static_dir, "trips"))
    if with_index:
        seg = global_row_number(slice_by_order(seg, ["trip_id", "arrival_time_unix", "stop_id"]),
                                ["trip_id", "arrival_time_unix", "stop_id"], "index")
    files.write_day_partitioned(_with_day(seg, d), out_dir, compression="snappy")


# ---------------------------------------------------------------- landing

def land_feed_job(spark: SparkSession, raw_dir: str, out_dir: str, entity: StructType,
                  tz: str = DEFAULT_TZ) -> None:
    """Decoded feed messages (one JSON document per poll file) -> flat rows by day and poll.

    Members that ``entity`` does not declare are kept with the type seen in the
    messages.  Messages that are no JSON object, and files without a poll time,
    go to ``<out_dir>_rejects``.
    """
    messages = landed_messages(spark, raw_dir, out_dir)
    seen = seen_schema(messages)
    if "entity" in seen.names and isinstance(seen["entity"].dataType, ArrayType):
        entity = fd.widened(entity, seen["entity"].dataType.elementType)
    land_rows(fd.flatten_feed(messages, entity, "message", keep=["timefetch"]), out_dir, tz)


def land_station_status_job(spark: SparkSession, raw_dir: str, out_dir: str,
                            tz: str = DEFAULT_TZ) -> None:
    """Station-status documents -> one row per station and poll, by day and poll.

    Fields and rejects as in ``land_feed_job``.
    """
    messages = landed_messages(spark, raw_dir, out_dir)
    document = fd.widened(fd.station_document_schema(), seen_schema(messages))
    stations = document["data"].dataType["stations"].dataType.elementType
    land_rows(fd.station_snapshot(messages, stations, "message", keep=["timefetch"]), out_dir, tz)


def landed_messages(spark: SparkSession, raw_dir: str, out_dir: str) -> DataFrame:
    """(message, timefetch) of the usable messages, read and parsed once; the others are written aside.

    The parsed messages are pinned: rejects, the schema seen and the rows all
    come from them, and the raw folder is not read again.
    """
    path = F.col("_metadata.file_path")
    raw = (spark.read.option("wholetext", "true").text(raw_dir)
           .select("value", path.alias("path"), fd.poll_time_from_path(path).alias("timefetch"))
           .withColumn("message", F.when(F.col("timefetch").isNotNull(), fd.parsed_message(F.col("value"))))
           .withColumn("value", F.when(F.col("message").isNull(), F.col("value"))))     # the text of rejects only
    parsed = checkpointed(raw)
    bad = F.col("message").isNull()
    folder = raw_dir.rstrip("/").rsplit("/", 1)[-1]
    files.write_rejects(parsed.where(bad).select("path", "value"), f"{out_dir.rstrip('/')}_rejects", folder)
    return parsed.where(~bad).select("message", "timefetch")


def seen_schema(messages: DataFrame) -> StructType:
    """The union of the messages' JSON types, as one aggregate over all of them."""
    seen = messages.agg(F.expr("schema_of_variant_agg(message)").alias("s")).first().s
    return _struct_of(seen) if seen else StructType()


def _struct_of(text: str) -> StructType:
    """A Spark type of a variant schema: OBJECT becomes a struct, a member of mixed or no type becomes text."""
    ddl = re.sub(r"\bOBJECT<", "STRUCT<", text)
    ddl = re.sub(r"\b(VOID|VARIANT)\b", "STRING", ddl)
    ddl = re.sub(r"\bDECIMAL\([0-9,]+\)", "DOUBLE", ddl)
    parsed = StructType.fromDDL(f"x {ddl}")["x"].dataType
    return parsed if isinstance(parsed, StructType) else StructType()


def land_rows(rows: DataFrame, out_dir: str, tz: str = DEFAULT_TZ) -> None:
    """Rows by local day and poll time: another poll of the day stays, the same poll replaces itself."""
    placed = rows.withColumn(DATE_COL, poll_date(F.col("timefetch"), tz)).withColumn("poll", F.col("timefetch"))
    files.write_day_partitioned(placed, out_dir, within=("poll",))


# ---------------------------------------------------------------- compaction of landed polls (SNK1, SNK8)

TARGET_FILE_BYTES = 256 << 20


def _landed_versions(spark: SparkSession, landed_dir: str, day: dt.date) -> DataFrame:
    """(poll, version, bytes) of a day's landed polls, from the listing alone.

    A poll that is landed again is written to files of new names, so the names are its version.
    """
    folder = f"{landed_dir.rstrip('/')}/{DATE_COL}={day.isoformat()}"
    if not files.path_exists(spark, folder):
        return spark.createDataFrame([], "poll bigint, version string, bytes bigint")
    return (census.listed(spark, folder, "*.parquet")
            .withColumn("poll", F.regexp_extract("path", r"/poll=([0-9]+)/", 1).try_cast("bigint"))
            .where(F.col("poll").isNotNull()).groupBy("poll")
            .agg(F.md5(F.array_join(F.sort_array(F.collect_list("path")), "\n").cast("binary")).alias("version"),
                 F.sum("length").alias("bytes")))


def read_landed_day(spark: SparkSession, landed_dir: str, days_dir: str, day) -> DataFrame:
    """A day's polls: what was folded into day files, and the polls that landed since, which replace their older selves."""
    d = as_date(day)
    versions = _landed_versions(spark, landed_dir, d).select("poll", "version")
    folded = None
    if files.path_exists(spark, days_dir):
        folded = gtfs.read_day(spark, days_dir, d).withColumn("poll", F.col("poll").cast("bigint"))
        versions = versions.join(folded.select("poll", "version").distinct(), ["poll", "version"], "left_anti")
    fresh = versions.collect()                                  # polls of one day
    if not fresh and folded is not None:
        return folded
    polls = [r.poll for r in fresh]
    rows = (gtfs.read_day(spark, landed_dir, d).where(F.col("poll").isin(polls)).withColumn("poll", F.col("poll").cast("bigint"))
            .join(F.broadcast(spark.createDataFrame([tuple(r) for r in fresh], "poll bigint, version string")), "poll"))
    if folded is None:
        return rows
    return folded.where(~F.col("poll").isin(polls)).unionByName(rows, allowMissingColumns=True)


def compact_landed_day(spark: SparkSession, landed_dir: str, days_dir: str, day,
                       target_bytes: int = TARGET_FILE_BYTES) -> int:
    """Fold a day's landed polls into day files of about ``target_bytes``, planned from the listed sizes.

    Rows that are stored in few bytes get smaller files: a task reads no more than
    ``files.ROWS_PER_FILE`` or so.
    The landed folders stay as they are (removing them is the store's retention);
    a poll that lands late or again is folded by the next run.  The number of files is returned.
    """
    d = as_date(day)
    total = _landed_versions(spark, landed_dir, d).agg(F.sum("bytes")).first()[0] or 0
    rows = checkpointed(read_landed_day(spark, landed_dir, days_dir, d))          # the day that is read is rewritten
    n = files.file_count(rows.count(), at_least=-(-total // target_bytes))
    files.write_day_partitioned(rows, days_dir, files_per_day=n, salt_cols=tuple(
        c for c in rows.columns if rows.schema[c].dataType.typeName() not in ("map", "variant")))
    return n


def poll_date(epoch_s, tz: str = DEFAULT_TZ):
    """Local calendar date of a poll epoch (the folder the reference files it under).

    Built on time-zone-free timestamps, so the session's zone plays no part.
    """
    utc = F.timestamp_add("SECOND", epoch_s, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc).cast("date")


# ---------------------------------------------------------------- bike history

STORED_TRIPS = ("startStationName string, endStationName string, startTimeMs bigint, endTimeMs double, "
                f"durationMs double, {files.LOAD} string")


def load_bike_trips(spark: SparkSession, csv_paths: Iterable[str], trips_path: str,
                    stations_path: str, load: str | None = None) -> dict:
    """One increment of historical trips: stations inserted if absent, then trips appended.

    The high-water mark is read once before anything is written (P11), so the
    whole increment is one DataFrame and one commit.  The trips, which move the
    mark, come last: a load that stops before them is repeated in full by the
    next run, and inserts no station twice.  A named ``load`` may run again at
    any time: its own rows do not count for the mark, and it replaces them.
    Returns counts and the skipped files.
    """
    trips, skipped = gtfs.read_trip_csvs(spark, csv_paths)
    if trips is None:
        return {"trips": 0, "stations": 0, "skipped": skipped}
    stored = files.read_or_empty(spark, trips_path, STORED_TRIPS)
    others = stored.where(F.col(files.LOAD) != load) if load else stored
    mark = others.agg(F.max("startTimeMs")).first()[0]
    increment = bk.high_water_increment(trips, mark=mark)
    # pin the increment: the trip rows and the station rows come from the same read
    increment = checkpointed(increment)
    new_trips = bk.bike_trip_durations(increment)
    added = files.insert_if_absent(spark, bk.station_locations(increment), stations_path, "name", load)
    if load:
        files.write_load(new_trips, trips_path, load, sort_within="startTimeMs")
    else:
        files.append(new_trips, trips_path, sort_within="startTimeMs")
    return {"trips": new_trips.count(), "stations": added.count(), "skipped": skipped}


def historical_load(spark: SparkSession, entries: DataFrame, csv_paths_of: dict[str, list[str]],
                    trips_path: str, stations_path: str, ledger_path: str, cdn_origin: str) -> list[dict]:
    """C11: load catalogue entries in year order; ledger row after each successful load.

    Stations, trips and ledger row of an entry are partitions named by its URL,
    so a run that stops between any two writes, or runs twice, leaves each once.

    ``entries`` holds (year, url) rows (a handful: one per catalogue year);
    ``csv_paths_of`` maps a trusted URL to its unpacked CSV files; a URL that is
    not there raises.  Years 2014-2021 are skipped (layout known, not
    implemented); earlier years raise.  A year none of whose files could be read
    is reported as empty and gets no ledger row, so it is tried again.
    """
    from ..functions.labels import trusted_url

    plan = (entries.select("year", trusted_url(F.col("url"), cdn_origin).alias("url"),
                           bk.year_layout(F.col("year")).alias("layout"))
            .orderBy("year").collect())        # one row per catalogue year
    done = []
    for row in plan:
        if row.layout is None:
            raise ValueError(f"Unsupported year {row.year}")
        if row.layout != "2022":
            done.append({"year": row.year, "url": row.url, "status": "skipped"})
            continue
        if row.url not in csv_paths_of:
            raise KeyError(f"no unpacked files for {row.url}")
        paths = list(csv_paths_of[row.url])
        stats = load_bike_trips(spark, paths, trips_path, stations_path, files.load_name(row.url))
        if len(stats["skipped"]) == len(paths):
            done.append({"year": row.year, "url": row.url, "status": "empty", **stats})
            continue
        files.add_ledger_entry(spark, ledger_path, row.url, row.year)
        done.append({"year": row.year, "url": row.url, "status": "loaded", **stats})
    return done
