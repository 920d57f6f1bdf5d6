"""What the files of a folder hold, found without a Spark job per file (A7, SRC5, SRC6, SRC10).

* ``parquet_census``: footers only.  Spark merges the files' schemas in parallel
  in one job; only where column types clash are the files, in name order, dealt
  over halves again, so a day whose types change at some poll costs a few jobs more,
  and a day of stable types none.  Which files can be read comes from one scan
  of no columns.
* ``header_census``: one job over the files' splits that keeps each file's first
  line.

Both return a row per distinct schema or header with the files that have it;
only file names and schemas reach the driver.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SKIP = {"ignoreCorruptFiles": "true"}
#: Bytes of a Parquet file without any content: the magic twice and a footer's length.
LEAST_PARQUET = 12
#: A file without rows is its footer: larger ones are not looked into.
EMPTY_PARQUET = 1 << 20


# ---------------------------------------------------------------- Parquet

def listed(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """(path, length) of the files under ``folder`` whose names match; no content is read.

    Spark's file sources leave out files of no bytes.
    """
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
            .load(folder).select("path", "length"))


def _merged_schema(spark: SparkSession, paths: Sequence[str]) -> StructType | None:
    """The union of the files' columns by one parallel read of footers; None if their types clash."""
    try:
        return spark.read.options(mergeSchema="true", **SKIP).parquet(*paths).schema
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE" in str(error):        # CANNOT_MERGE_SCHEMAS, or its causes
            return None
        raise


def same_types(a: StructType, b: StructType) -> bool:
    own = {f.name: f.dataType for f in a.fields}
    return all(own.get(f.name, f.dataType) == f.dataType for f in b.fields)


def union_of(a: StructType, b: StructType) -> StructType:
    names = set(a.names)
    return StructType([*a.fields, *[f for f in b.fields if f.name not in names]])


def schema_groups(spark: SparkSession, paths: Sequence[str]) -> list[tuple[StructType, list[str]]]:
    """Readable files by schema; a group unites files that differ only in which columns they have.

    Jobs: one without clashes; else about 2 log2(files) for each place, in name
    order, where the types change.
    """
    groups: list[tuple[StructType, list[str]]] = []
    pending = [list(paths)] if paths else []
    while pending:
        part = pending.pop()
        schema = _merged_schema(spark, part)
        if schema is None:
            half = len(part) // 2
            pending += [part[half:], part[:half]]
            continue
        for k, (known, files) in enumerate(groups):
            if same_types(known, schema):
                groups[k] = (union_of(known, schema), files + part)
                break
        else:
            groups.append((schema, part))
    return groups


def parquet_census(spark: SparkSession, folder: str, glob: str = "*.parquet") -> tuple[
        list[tuple[StructType, list[str]]], DataFrame]:
    """SRC6 + A7: the readable Parquet files under ``folder`` by schema, and (path, length) of the others."""
    files = listed(spark, folder, glob)
    good = readable(spark, [r.path for r in files.where(F.col("length") >= LEAST_PARQUET).select("path").collect()])
    known = spark.createDataFrame([(p,) for p in good], "path string")
    return schema_groups(spark, good), files.join(known, "path", "left_anti")


def census_of(spark: SparkSession, paths: Sequence[str]) -> tuple[list[tuple[StructType, list[str]]], list[str]]:
    """``parquet_census`` of given files: the readable ones by schema, and the others."""
    good = readable(spark, paths)
    return schema_groups(spark, good), sorted(set(paths) - set(good))


def readable(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """SRC6: the paths, sorted, that are Parquet files, by their footers alone.

    Files with rows show in a scan of no columns, which passes over what has no
    footer.  What it does not show is either no Parquet file or has no rows;
    a file without rows is small, so of the small ones the magic bytes tell.
    """
    if not paths:
        return []
    own = {plain_path(p): p for p in paths}
    scan = spark.read.schema("_none string").options(**SKIP).parquet(*own.values())
    seen = {own[p] for p in (plain_path(unquote(r.path)) for r in
                             scan.select(F.col("_metadata.file_path").alias("path")).distinct().collect()) if p in own}
    unseen = sorted(set(own.values()) - seen)
    if unseen:
        magic = F.lit("PAR1").cast("binary")
        small = spark.read.format("binaryFile").load(unseen).where(F.col("length").between(LEAST_PARQUET, EMPTY_PARQUET))
        ends = (F.substring("content", 1, 4) == magic) & (F.substring("content", -4, 4) == magic)
        seen |= {own[plain_path(r.path)] for r in small.where(ends).select("path").collect()}
    return sorted(seen)


def plain_path(path: str) -> str:
    """A path without scheme and host, to compare names as given with names as Spark reports them."""
    return re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "", path)


# ---------------------------------------------------------------- headers

def first_lines(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """The first line of every file that is there and not empty, by its path as given; one job, a task per split.

    Of a split at a file's start, the row at place 0 is kept; no row goes through Python
    (a Python worker that stops after its first row is still sent all the others).
    """
    session = spark.newSession()
    session.conf.set("spark.sql.files.openCostInBytes", str(1 << 50))       # splits are not packed together
    at_start = (F.col("start") == 0) & (F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0)
    paths = list(dict.fromkeys(paths))
    while paths:
        try:
            lines = session.read.text(paths).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"),
                                                    F.col("_metadata.file_block_start").alias("start"))
            found = lines.where(at_start).select("path", "line").collect()        # a row per file
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            gone = plain_path((error.getMessageParameters() or {}).get("path", ""))
            left = [p for p in paths if plain_path(p) != gone]
            if len(left) == len(paths):
                raise
            paths = left
            continue
        own = {plain_path(p): p for p in paths}
        return {own[plain_path(unquote(r.path))]: r.line for r in found if plain_path(unquote(r.path)) in own}
    return {}


def header_census(spark: SparkSession, paths: Iterable[str]) -> tuple[dict[tuple[str, ...], list[str]], list[str]]:
    """SRC10: files by their header, in the order given, and those that are missing or empty."""
    paths = list(paths)
    lines = first_lines(spark, paths)
    groups: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        if path in lines:
            header = tuple(c.strip() for c in next(csv.reader([lines[path].lstrip("﻿")]), []))
            groups.setdefault(header, []).append(path)
    return groups, [p for p in paths if p not in lines]
