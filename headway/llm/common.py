"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.session import ensure_checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """(doc_id, text) only; a null text is empty.  Other columns, whatever their names, are not read."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))


def pinned(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder (``spark.checkpoint.dir``)."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        ensure_checkpoint_dir(spark)
    return df.checkpoint(eager=True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def share_vocabulary(spark: SparkSession, path: str):
    """Broadcast a tokenizer file's bytes: read once on the driver, a fixed size of a few MB.

    The dictionary also serves the workers as the place of what they derive
    from the file (parsed tables, caches): a broadcast value lives as long as
    the worker process.
    """
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast({"file": f.read()})


def fold(column, modulus: int):
    """crc32 of the id's decimal text, modulo ``modulus`` (null id: the empty text)."""
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def group_key(column):
    """A group's text key that is never null: nulls sort first, then texts bytewise."""
    return F.coalesce(F.concat(F.lit("1"), column.cast("string")), F.lit("0"))


def numbered_within(rows: DataFrame, group: str, order: list, totals: list = ()) -> tuple[DataFrame, DataFrame]:
    """Places of rows within their group, without a task that holds a group.

    Rows are range-partitioned by (``group``, ``order``), so a large group spans
    many slices.  Returns the checkpointed rows with ``_slice`` and ``_at``, and
    a table of one row per group and slice that meets them on (``group``,
    ``_slice``): ``_at + _shift`` is a row's place in its group from 0, ``_n``
    the group's rows.  Rows that tie in ``order`` are spread by their position
    in the input and take consecutive places.  ``group`` must not be null.
    ``totals`` are aggregates of the whole group to add, as (name, column).
    """
    parts = shuffle_partitions(rows.sparkSession)
    keys = [F.col(group), *order, F.col("_tie")]
    place = F.monotonically_increasing_id()         # slice number, then position in the sorted slice
    sliced = pinned(pinned(rows).withColumn("_tie", place)
                    .repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("_tie")
                    .withColumn("_at", place)
                    .withColumn("_slice", F.shiftright("_at", 33).cast("int"))
                    .withColumn("_at", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))))
    tallies = sliced.groupBy(group, "_slice").agg(
        F.count("*").alias("_n"), F.min("_at").alias("_first"), *[F.sum(c).alias(name) for name, c in totals])
    own = Window.partitionBy(group)                 # at most one row per slice
    table = pinned(tallies.select(
        group, "_slice", (F.sum("_n").over(own.orderBy("_slice")) - F.col("_n") - F.col("_first")).alias("_shift"),
        F.sum("_n").over(own).alias("_n"), *[F.sum(name).over(own).alias(name) for name, _ in totals]))
    return sliced, table
