"""Landed feeds: flattening (C7), station snapshots (C8), merging a day of polls.

Feeds arrive as decoded JSON text (Protobuf wire decoding is not part of the
engine).  Parsing uses declared schemas with ``from_json``; one poll file
becomes rows through ``explode``/``inline``, and a day of poll files is one
split-parallel scan instead of a listing loop with a thread pool.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DataType, DoubleType, LongType, StringType, StructField,
                               StructType)

from ..functions.flatten import flatten


FAILFAST = {"mode": "FAILFAST"}


def _s(*fields: StructField) -> StructType:
    return StructType(list(fields))


def _f(name: str, dtype) -> StructField:
    return StructField(name, dtype, True)


TRIP_DESCRIPTOR = _s(_f("tripId", StringType()), _f("routeId", StringType()),
                     _f("startTime", StringType()), _f("startDate", StringType()),
                     _f("directionId", LongType()))

# GTFS-realtime VehiclePosition entity as decoded JSON (64-bit integers arrive as text)
VEHICLE_ENTITY = _s(
    _f("id", StringType()),
    _f("vehicle", _s(
        _f("trip", TRIP_DESCRIPTOR),
        _f("vehicle", _s(_f("id", StringType()), _f("label", StringType()))),
        _f("position", _s(_f("latitude", DoubleType()), _f("longitude", DoubleType()),
                          _f("bearing", DoubleType()), _f("speed", DoubleType()))),
        _f("currentStopSequence", LongType()),
        _f("currentStatus", StringType()),
        _f("timestamp", StringType()),
        _f("occupancyStatus", StringType()),
    )),
)

STOP_TIME_EVENT = _s(_f("delay", LongType()), _f("time", StringType()))

# GTFS-realtime TripUpdate entity; the repeated stopTimeUpdate stays an array column
TRIP_UPDATE_ENTITY = _s(
    _f("id", StringType()),
    _f("tripUpdate", _s(
        _f("trip", TRIP_DESCRIPTOR),
        _f("vehicle", _s(_f("id", StringType()))),
        _f("timestamp", StringType()),
        _f("stopTimeUpdate", ArrayType(_s(
            _f("stopSequence", LongType()), _f("stopId", StringType()),
            _f("arrival", STOP_TIME_EVENT), _f("departure", STOP_TIME_EVENT),
            _f("scheduleRelationship", StringType())))),
    )),
)


def feed_message_schema(entity: StructType) -> StructType:
    header = _s(_f("gtfsRealtimeVersion", StringType()), _f("incrementality", StringType()),
                _f("timestamp", StringType()))
    return _s(_f("header", header), _f("entity", ArrayType(entity)))


# GBFS station_status document; stations keep the fields the caller declares
STATION_STATUS_FIELDS = _s(
    _f("station_id", StringType()),
    _f("num_bikes_available", LongType()),
    _f("num_ebikes_available", LongType()),
    _f("num_bikes_disabled", LongType()),
    _f("num_docks_available", LongType()),
    _f("num_docks_disabled", LongType()),
    _f("is_installed", LongType()),
    _f("is_renting", LongType()),
    _f("is_returning", LongType()),
    _f("last_reported", LongType()),
)


def station_document_schema(stations: StructType = STATION_STATUS_FIELDS) -> StructType:
    return _s(_f("last_updated", LongType()), _f("ttl", LongType()),
              _f("data", _s(_f("stations", ArrayType(stations)))))


def poll_time_from_path(path: Column) -> Column:
    """SRC7: poll epoch from a file name ``..._<digits>.<ext>``; null when the name has none."""
    digits = F.regexp_extract(path, r"_([0-9]+)\.[^/]*$", 1)
    return F.when(digits != "", digits).try_cast("bigint")


def flatten_entities(entities: DataFrame) -> DataFrame:
    """SRC2/SRC3 + F11 + O2: one flat row per entity, nested names joined by ``_``, sorted."""
    return flatten(entities)


def widened(declared: DataType, seen: DataType) -> DataType:
    """The declared type with every further member that the data hold."""
    if isinstance(declared, StructType) and isinstance(seen, StructType):
        own = {f.name: f for f in declared.fields}
        inner = {f.name: f.dataType for f in seen.fields}
        return StructType([StructField(n, widened(f.dataType, inner[n]) if n in inner else f.dataType, True)
                           for n, f in own.items()] + [f for f in seen.fields if f.name not in own])
    if isinstance(declared, ArrayType) and isinstance(seen, ArrayType):
        return ArrayType(widened(declared.elementType, seen.elementType))
    return declared


def parsed_message(text: Column) -> Column:
    """A message as VARIANT; null if it is no JSON object."""
    return F.when(F.ltrim(text).startswith("{"), F.try_parse_json(text))


def _document(messages: DataFrame, col: str, schema: StructType) -> Column:
    """A message, JSON text or already parsed (VARIANT), as a struct; a malformed one fails the query."""
    if messages.schema[col].dataType.typeName() == "variant":
        return F.col(col).cast(schema)
    return F.from_json(F.col(col), schema, FAILFAST)


def flatten_feed(messages: DataFrame, entity: StructType, text_col: str = "value",
                 keep: Sequence[str] = ()) -> DataFrame:
    """Decoded feed messages (JSON text, or VARIANT) -> flat entity rows.

    ``keep`` carries columns of the message row (e.g. ``timefetch``) onto every entity.
    A malformed message fails the query; jobs put such messages aside first.
    """
    parsed = messages.select(*keep, _document(messages, text_col, feed_message_schema(entity)).alias("m"))
    entities = parsed.select(*keep, F.explode("m.entity").alias("e")).select(*keep, "e.*")
    return flatten(entities)


def station_snapshot(documents: DataFrame, stations: StructType = STATION_STATUS_FIELDS,
                     text_col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """C8 + SRC4 + F12: station-status documents -> one row per station (``data.stations``)."""
    parsed = documents.select(*keep, _document(documents, text_col, station_document_schema(stations)).alias("d"))
    return parsed.select(*keep, F.inline("d.data.stations"))


def merge_polls(frames: Sequence[DataFrame]) -> DataFrame:
    """U2 + P15 + O2: union of poll frames whose columns drifted; missing columns are null."""
    if not frames:
        raise ValueError("no poll frames to merge")
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged.select(*sorted(merged.columns))


def conform_polls(polls: DataFrame, path_col: str = "file_path") -> DataFrame:
    """SRC7 + P15: fill ``timefetch`` from the file name where the file had none.

    Rows whose poll time is known neither way keep a null time: it is for the
    caller to put them aside (``timefetch is null``).
    """
    timefetch = F.coalesce(F.col("timefetch").cast("bigint"), poll_time_from_path(F.col(path_col)))
    out = polls.withColumn("timefetch", timefetch).drop(path_col)
    return out.select(*sorted(out.columns))
