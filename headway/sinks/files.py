"""Sinks and load bookkeeping (SNK1-SNK9) over Parquet folders.

Writes are whole-DataFrame commits (the output committer makes them atomic per
job), so a retried job never leaves half a batch.  Tables read and rewritten
by the same job are checkpointed first to cut the lineage to the old files.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.labels import readable_size
from ..session import ensure_checkpoint_dir

# Spark's error conditions of a folder that is not there, or holds no file yet
MISSING = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table is stored there.  Only a missing or empty folder means no; other errors are raised."""
    try:
        spark.read.parquet(path).schema  # noqa: B018 - schema resolution lists the folder
        return True
    except AnalysisException as error:
        if error.getCondition() in MISSING:
            return False
        raise


def read_or_empty(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


#: Rows of a file whose count is planned: one task reads and writes a file.
ROWS_PER_FILE = 1 << 22


def file_count(rows: int, at_least: int = 1) -> int:
    """Files for a day of so many rows, so that no task writes more than ``ROWS_PER_FILE`` or so."""
    return max(at_least, -(-rows // ROWS_PER_FILE))


def write_day_partitioned(df: DataFrame, path: str, date_col: str = "service_date",
                          files_per_day: int | None = None, compression: str = "gzip",
                          salt_cols: tuple[str, ...] = (), within: tuple[str, ...] = ()) -> None:
    """SNK1 + SNK8 + SNK2: compacted, gzip Parquet by day; rewrites only the days present.

    ``within`` names further partition columns: with the poll time there, a poll
    replaces itself when it is landed again, and never another poll of its day.

    By default rows are rebalanced by day: AQE writes a small day as one file
    and splits a large day into advisory-size files, so no day is funnelled
    through one task.  ``files_per_day`` instead fixes the count, rows spread by
    a hash of ``salt_cols``; ``file_count`` gives one that large days can have.
    """
    if files_per_day is None:
        shaped = df.hint("rebalance", date_col, *within)
    else:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in (salt_cols or df.columns)]), F.lit(files_per_day))
        shaped = df.repartition(F.col(date_col), *[F.col(c) for c in within], salt)
    (shaped.write.mode("overwrite").option("compression", compression)
     .option("partitionOverwriteMode", "dynamic").partitionBy(date_col, *within).parquet(path))


LOAD = "load"            # partition column of tables that named loads write
UNNAMED = "increment"    # loads that replace nothing


def load_name(key: str) -> str:
    """A load's partition name, from what identifies it (a URL, say)."""
    return hashlib.sha256(key.encode()).hexdigest()[:24]


def append(df: DataFrame, path: str, sort_within: str | None = None) -> None:
    """SNK4: append rows; ``sort_within`` clusters row groups for min/max skipping."""
    out = df.sortWithinPartitions(sort_within) if sort_within else df
    out.withColumn(LOAD, F.lit(UNNAMED)).write.mode("append").partitionBy(LOAD).parquet(path)


def write_load(df: DataFrame, path: str, load: str, sort_within: str | None = None) -> None:
    """SNK4 for a named load: its own partition, overwritten, so a load that is run again replaces itself."""
    out = df.sortWithinPartitions(sort_within) if sort_within else df
    (out.withColumn(LOAD, F.lit(load)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(LOAD).parquet(path))


def insert_if_absent(spark: SparkSession, new: DataFrame, path: str, key: str, load: str | None = None) -> DataFrame:
    """SNK5: append rows whose ``key`` is not stored yet; stored rows never change.

    A named ``load`` that runs again replaces the rows that it inserted before,
    so two runs of it at once insert each row once.
    """
    if path_exists(spark, path):
        existing = spark.read.parquet(path)
        others = existing.where(F.col(LOAD) != load) if load else existing
        added = new.join(others.select(key), key, "left_anti")
    else:
        added = new
    ensure_checkpoint_dir(spark)
    added = added.checkpoint(eager=True)
    if load:
        write_load(added, path, load)
    else:
        append(added, path)
    return added


def add_ledger_entry(spark: SparkSession, path: str, url: str, year: int) -> None:
    """SNK6: record a loaded URL; a URL already recorded is an error.

    An entry is a partition of its own, so two runs that pass the check at once
    still leave one row.
    """
    row = spark.createDataFrame([(url, int(year))], "url string, year int")
    if path_exists(spark, path):
        if not spark.read.parquet(path).where(F.col("url") == url).isEmpty():
            raise ValueError(f"url already loaded: {url}")
    write_load(row, path, load_name(url))


def replace_small_table(df: DataFrame, path: str) -> None:
    """Rewrite a small bookkeeping table that ``df`` may itself read from."""
    ensure_checkpoint_dir(df.sparkSession)
    df.checkpoint(eager=True).write.mode("overwrite").parquet(path)


def write_rejects(df: DataFrame, path: str, run: str) -> int:
    """Keep what a run could not use, under ``run=<name>``; a rerun replaces its own.  Returns the row count.

    ``df`` must be pinned: it is counted, and written only if it has rows.
    """
    n = df.count()
    if n or path_exists(df.sparkSession, path):
        (df.withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run").parquet(path))
    return n


def table_stats(spark: SparkSession, path: str) -> DataFrame:
    """SNK9: rows, storage bytes, mean row bytes and a readable size of a Parquet table."""
    df = spark.read.parquet(path)
    # one pass: rows and size per file, then totals (no join of two aggregates)
    per_file = (df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("b"))
                .groupBy("f").agg(F.count(F.lit(1)).alias("n"), F.max("b").alias("b")))
    totals = per_file.agg(F.sum("n").alias("rows"), F.sum("b").alias("storage_bytes"))
    return (totals
            .select(F.coalesce("rows", F.lit(0)).alias("rows"), "storage_bytes",
                    F.when(F.col("rows") > 0, F.col("storage_bytes") / F.col("rows")).alias("mean_row_bytes"),
                    readable_size(F.col("storage_bytes")).alias("size")))


def run_date(day: str | dt.date | None, tz: str, shift_days: int) -> dt.date:
    """F8: a job's processing date from its run date (default: today in ``tz``)."""
    import zoneinfo

    if day is None:
        base = dt.datetime.now(zoneinfo.ZoneInfo(tz)).date()
    else:
        from ..functions.clock import as_date
        base = as_date(day)
    return base + dt.timedelta(days=shift_days)
