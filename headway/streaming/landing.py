"""Structured Streaming landing jobs (STR1, STR2).

The reference polls on a schedule and later re-lists and re-reads every file
of a day.  Here the landing folder is a streaming file source: each trigger
picks up only files not seen before (the checkpoint remembers them), and
``availableNow`` processes the backlog and stops, so the same job runs as a
scheduled batch or continuously.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.clock import DEFAULT_TZ
from ..operators.ordered import checkpointed
from ..plans import bikeshare as bk
from ..plans import feeds as fd
from ..plans.jobs import poll_date, read_polls
from ..sinks import files
from ..sources import census, gtfs


FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def _new_files(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """A stream of the names of files not seen before; their content is not read."""
    return (spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").load(folder).select("path"))


def positions_landing_stream(spark: SparkSession, landing_dir: str, table_dir: str,
                             checkpoint_dir: str, schema: StructType, tz: str = DEFAULT_TZ,
                             available_now: bool = True) -> StreamingQuery:
    """STR1: poll files -> day table partitioned by ``service_date`` and ``load_batch``.

    The stream carries file names.  Each micro-batch takes a census of its files
    (a fixed number of jobs, footers only) and unites what they hold: ``schema``
    gives the types of the columns it names, every other column is kept (read the
    table with ``mergeSchema``), columns that a file lacks are null.  Files that
    are no Parquet go to ``<table_dir>_rejects`` and do not stop the stream.

    ``timefetch`` is taken from the file name when the file lacks it (SRC7) and
    gives the row's service date; rows whose poll time is known neither way land
    in the partition without a date.  A micro-batch writes its own ``load_batch``
    partitions, overwritten on a replay, so a batch never lands twice.
    """
    def land(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        paths = sorted(r.path for r in batch.collect())          # names of the micro-batch's files
        groups, bad = census.census_of(session, paths)
        rejects = checkpointed(session.createDataFrame([(p, "not a Parquet file") for p in bad], "path string, reason string"))
        files.write_rejects(rejects, f"{table_dir.rstrip('/')}_rejects", str(epoch_id))
        if not groups:
            return
        rows = fd.conform_polls(read_polls(session, groups, schema))
        placed = rows.withColumn("service_date", poll_date(F.col("timefetch"), tz)).withColumn("load_batch", F.lit(epoch_id))
        files.write_day_partitioned(placed, table_dir, within=("load_batch",))

    writer = _new_files(spark, landing_dir, "*.parquet").writeStream.foreachBatch(land).option(
        "checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def bike_trips_stream(spark: SparkSession, csv_dir: str, trips_path: str, stations_path: str,
                      checkpoint_dir: str, available_now: bool = True) -> StreamingQuery:
    """STR2: new trip CSV files -> stations inserted if absent, trips appended (per micro-batch).

    The stream carries file names only; each micro-batch reads its files by
    their own headers (SRC5, P13), so a reordered file is not mislabelled, and
    files without a required column go to ``<trips_path>_rejects``.

    The stream's checkpoint replaces the high-water mark for files already
    seen: a file is processed once, whatever its time range.  Trips of a
    micro-batch land in their own ``load_batch`` partition, overwritten on a
    retry, so a replayed batch never duplicates rows.
    """
    def load(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        paths = sorted(r.path for r in batch.collect())          # names of the micro-batch's files
        trips, skipped = gtfs.read_trip_csvs(session, paths)
        rejects = checkpointed(session.createDataFrame([(p,) for p in skipped], "path string"))
        files.write_rejects(rejects, f"{trips_path.rstrip('/')}_rejects", str(epoch_id))
        if trips is None:
            return
        trips = checkpointed(trips)
        files.insert_if_absent(session, bk.station_locations(trips), stations_path, "name", f"batch-{epoch_id}")
        (bk.bike_trip_durations(trips).withColumn("load_batch", F.lit(epoch_id))
         .sortWithinPartitions("startTimeMs")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("load_batch").parquet(trips_path))

    writer = _new_files(spark, csv_dir, "*.csv").writeStream.foreachBatch(load).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")
    return writer.start()
