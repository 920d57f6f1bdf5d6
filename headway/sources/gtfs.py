"""File sources: static GTFS text tables (SRC1), trip CSVs (SRC5, SRC10, P13), day scans (SRC6-SRC9, SRC11).

Types are declared, never inferred.  A CSV header decides only the *order* of
the declared columns (GTFS and trip files list columns in any order); headers
and schemas of many files come from a fixed number of jobs (``sources.census``).
"""

from __future__ import annotations

import datetime as dt
import functools
import os
import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DataType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType)

from ..functions.clock import as_date
from ..plans.bikeshare import REQUIRED_COLUMNS, has_required_columns, normalise_trip_columns
from .census import header_census, listed

S, I, L, D = StringType(), IntegerType(), LongType(), DoubleType()

# Declared types of the static schedule columns the jobs use; others are read as text.
GTFS_TYPES: dict[str, dict[str, DataType]] = {
    "calendar": {"service_id": S, "monday": I, "tuesday": I, "wednesday": I, "thursday": I,
                 "friday": I, "saturday": I, "sunday": I, "start_date": S, "end_date": S},
    "trips": {"route_id": S, "service_id": S, "trip_id": S, "trip_headsign": S, "direction_id": I,
              "shape_id": S, "wheelchair_accessible": I},
    "stop_times": {"trip_id": S, "arrival_time": S, "departure_time": S, "stop_id": S,
                   "stop_sequence": L},
    "stops": {"stop_id": S, "stop_name": S, "stop_lat": D, "stop_lon": D, "wheelchair_boarding": I},
    "routes": {"route_id": S, "route_long_name": S, "route_short_name": S, "route_type": I},
}

# Declared types of the 2022+ trip file columns (end time has a fraction in the files)
TRIP_CSV_TYPES: dict[str, DataType] = {
    "startstationname": S, "startstationarrondissement": S, "startstationlatitude": D,
    "startstationlongitude": D, "endstationname": S, "endstationarrondissement": S,
    "endstationlatitude": D, "endstationlongitude": D, "starttimems": L, "endtimems": D,
}


def list_files(spark: SparkSession, root: str, glob: str) -> list[str]:
    """File paths under ``root`` matching ``glob`` (listing only; contents are not read)."""
    return sorted(r.path for r in listed(spark, root, glob).select("path").collect())


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """SRC10: column names of a CSV file, or of a folder of CSV parts, from a first line."""
    return list(_headers(spark, {path: list_files(spark, path, "*")})[path])


def _headers(spark: SparkSession, parts: dict[str, list[str]]) -> dict[str, tuple[str, ...]]:
    """The header of each table from its first part that has one; one job for all."""
    groups, _ = header_census(spark, [p for files in parts.values() for p in files])
    of = {path: header for header, paths in groups.items() for path in paths}
    found = {table: next((of[p] for p in files if p in of), None) for table, files in parts.items()}
    if missing := [t for t, header in found.items() if header is None]:
        raise ValueError(f"no header line in {missing}")
    return found


def header_schema(header: Sequence[str], types: dict[str, DataType], case_insensitive: bool = False) -> StructType:
    def typ(name: str) -> DataType:
        return types.get(name.lower() if case_insensitive else name, S)
    return StructType([StructField(c, typ(c), True) for c in header])


def read_gtfs_table(spark: SparkSession, path: str, table: str, header: Sequence[str] | None = None) -> DataFrame:
    """SRC1: one static text table with declared types in the file's column order."""
    schema = header_schema(header or csv_header(spark, path), GTFS_TYPES.get(table, {}))
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def convert_feed_tables(spark: SparkSession, feed_dir: str, out_dir: str) -> list[str]:
    """SRC1: every ``<table>.txt`` of an unpacked feed, a file or a folder of parts -> ``<out_dir>/<table>/`` Parquet.

    The headers of all tables come from one job; then there is one write per table.
    """
    parts: dict[str, list[str]] = {}
    for path in list_files(spark, feed_dir, "*"):
        if found := re.match(r"(.*/[^/]+\.txt)(/[^/]+)?$", path):
            parts.setdefault(found[1], []).append(path)
    headers, written = _headers(spark, parts), []
    for path in sorted(parts):
        table = os.path.splitext(os.path.basename(path))[0]
        read_gtfs_table(spark, path, table, headers[path]).write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/{table}")
        written.append(table)
    return written


def read_trip_csvs(spark: SparkSession, paths: Iterable[str]) -> tuple[DataFrame | None, list[str]]:
    """SRC5 + P13 + P2: trip CSVs -> one normalised DataFrame, plus the skipped files.

    Missing files and files missing a required column are skipped (reported,
    not fatal).  Headers come from one job over all files; files sharing a header
    are read by one split-parallel scan.  A malformed number fails it rather than
    being stored as null.
    """
    paths = list(paths)
    groups, missing = header_census(spark, paths)
    usable = {h: files for h, files in groups.items() if has_required_columns(h, REQUIRED_COLUMNS)}
    kept = {p for files in usable.values() for p in files}
    frames = []
    for header, files in usable.items():
        schema = header_schema(header, TRIP_CSV_TYPES, case_insensitive=True)
        raw = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(files)
        frames.append(normalise_trip_columns(raw))
    out = functools.reduce(DataFrame.unionByName, frames) if frames else None
    return out, [p for p in paths if p not in kept]


def read_day(spark: SparkSession, root: str, day: str | dt.date, schema: StructType | None = None,
             date_col: str = "service_date", next_day: bool = False) -> DataFrame:
    """SRC6/SRC8/SRC11: the day's (and optionally next day's) rows of a date-partitioned table.

    The date filter prunes partitions.  A corrupt file fails the job: a day cut
    short would look like a quiet one.
    """
    d = as_date(day)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(root)
    days = [d, d + dt.timedelta(days=1)] if next_day else [d]
    return df.where(F.col(date_col).isin(*days))


def read_day_required(spark: SparkSession, root: str, day: str | dt.date, **kw) -> DataFrame:
    """SRC9: like ``read_day`` but a clear error when the day has no data."""
    df = read_day(spark, root, day, **kw)
    if df.isEmpty():
        raise FileNotFoundError(f"no rows for {as_date(day)} under {root}")
    return df
