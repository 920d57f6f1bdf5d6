"""Bucketed tables: a day layout that joins by trip can use without an exchange.

A day's schedule is joined with the polls (J3), the trips (J6) and the kept
stops (J4) again and again.  Stored in buckets of its join key, its side of
those joins is read in place: only the other side moves.  Buckets are written by
one exchange, a file per bucket, sorted by the key, so that row groups hold narrow
key ranges.  The folder is given, so that it can be in the shared store.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..session import partition_count

# Keys of the layouts the plans use
BY_TRIP = ("trip_id",)                          # J2, J6
BY_STOP = ("trip_id", "stop_sequence")          # J3, J4: a hot trip is spread over its stops


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Store ``df`` at ``path`` as ``table``, bucketed and sorted by ``keys``, and read it back.

    ``buckets`` defaults to the partitions of an exchange, the number that the other side
    of a join is dealt into.  A table of that name is replaced.
    """
    spark = df.sparkSession
    n = buckets or partition_count(spark)
    (df.repartition(n, *keys).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(n, *keys).sortBy(*keys).saveAsTable(table))
    return spark.table(table)
