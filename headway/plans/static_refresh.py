"""Static schedule refresh (C12): freshness gate (SNK7) and text-table conversion (SRC1).

The gate compares the source's HTTP ``Last-Modified`` with the stored value
per source in one join; a source never stored is always reloaded.  The new
marker is written only after the tables, so a failed refresh is retried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import gtfs

HTTP_DATE_BODY = "dd MMM yyyy HH:mm:ss"


def parse_http_date(text: Column) -> Column:
    """``Fri, 01 Dec 2023 10:00:00 GMT`` -> TIMESTAMP (UTC).

    Spark refuses the weekday letter pattern when parsing, so the weekday and
    the trailing zone name are cut off and the rest is parsed.
    """
    body = F.regexp_extract(text, r"^[A-Za-z]{3}, (.*) GMT$", 1)
    return F.to_timestamp(F.when(body != "", body), HTTP_DATE_BODY)


def freshness_gate(incoming: DataFrame, stored: DataFrame, key: str = "source_id") -> DataFrame:
    """SNK7: per source, reload when nothing is stored or the source is strictly newer.

    ``incoming`` and ``stored`` have (``key``, ``last_modified``); the result has
    (``key``, ``last_modified``, ``stored_last_modified``, ``reload``).
    """
    s = stored.select(key, F.col("last_modified").alias("stored_last_modified"))
    joined = incoming.select(key, "last_modified").join(s, key, "left")
    newer = parse_http_date(F.col("last_modified")) > parse_http_date(F.col("stored_last_modified"))
    return joined.withColumn("reload", F.col("stored_last_modified").isNull() | newer)


def refresh_static(spark: SparkSession, feed_dir: str, out_dir: str, incoming_last_modified: str,
                   ledger_path: str, source_id: str = "gtfs_static") -> bool:
    """Convert every text table of an unpacked static feed when the source is newer.

    Returns True when tables were (re)written.  The ledger is a small parquet
    table (source_id, last_modified) in the shared store.
    """
    from ..sinks import files

    incoming = spark.createDataFrame([(source_id, incoming_last_modified)], "source_id string, last_modified string")
    stored = files.read_or_empty(spark, ledger_path, "source_id string, last_modified string")
    decision = freshness_gate(incoming, stored).where(F.col("reload"))
    if decision.isEmpty():
        return False
    gtfs.convert_feed_tables(spark, feed_dir, out_dir)
    # marker last: a crash before this line means the next run reloads
    kept = stored.join(incoming.select("source_id"), "source_id", "left_anti")
    files.replace_small_table(kept.unionByName(incoming), ledger_path)
    return True
