"""Operator 3, sharding: a keyed Feistel permutation over global row numbers (DataFrame functions only).

Law ``rows``: with N rows and S shards, a row whose permuted number is p goes to
shard ``p mod S`` as its slot ``p div S``.  So counts are at most one apart,
slots are gapless, and both can be computed from a row number alone.

* Row numbers: rows are counted per bucket of their hash (``BUCKETS`` buckets,
  whatever the cluster), numbered within the bucket by (hash, id, size,
  checksum), and moved by the rows of the buckets before it.  They depend on the
  rows only, not on partitions, so the shuffle is reproducible.  Equal rows are
  counted before the exchange and take consecutive numbers, so a row that fills
  a third of the table is one counter.
* Permutation: the numbers below a*b (a = ceil(sqrt N), b = ceil(N / a)) are
  pairs (l, r) of Z_a x Z_b; each round adds a keyed hash of r to l, then one of
  l to r.  Results of N or more are permuted again (cycle walking).  Fewer than
  a numbers lie outside, and the longest walk through them is found beforehand,
  so the walk needs no loop over the data.

Null text: no bytes, size 16, checksum 0.  Texts of any length count whole.  A null id is a value like any other.
Repeated rows get slots of their own.  An empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.llm.common import pinned

SHARDS = 40
BUCKETS = 4096
ROUNDS = 6
SEED = 20240229


def _div(x: Column, by: int) -> Column:
    return ((x - F.pmod(x, F.lit(by))) / F.lit(by)).cast("long")


def _permuted(x: Column, a: int, b: int, seed: int) -> Column:
    """One pass of the Feistel network over Z_a x Z_b."""
    def turn(pair: Column, key: Column) -> Column:
        left = F.pmod(pair["l"] + F.pmod(F.xxhash64(pair["r"], key), F.lit(a)), F.lit(a))
        right = F.pmod(pair["r"] + F.pmod(F.xxhash64(left, key + F.lit(1)), F.lit(b)), F.lit(b))
        return F.struct(left.alias("l"), right.alias("r"))

    keys = F.array(*[F.lit(seed + 2 * k).cast("long") for k in range(ROUNDS)])
    start = F.struct(F.pmod(x, F.lit(a)).cast("long").alias("l"), _div(x, a).alias("r"))
    return F.aggregate(keys, start, turn, lambda p: p["r"] * F.lit(a) + p["l"])


def _sides(n: int) -> tuple[int, int]:
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def walk_length(spark: SparkSession, n: int, seed: int = SEED) -> int:
    """How often a number below n can be permuted to n or more in a row: from the fewer than sqrt(n)+1 outsiders."""
    a, b = _sides(n)
    steps, now = 0, spark.range(n, a * b).select(F.col("id").alias("x"))
    size = a * b - n
    while size:
        now = spark.createDataFrame([(r.x,) for r in now.select(_permuted(F.col("x"), a, b, seed).alias("x"))
                                     .where(F.col("x") >= n).collect()], "x long")
        left, steps = now.count(), steps + 1
        if left == size:        # only closed walks outside are left, which no number below n enters
            break
        size = left
    return steps


def permute(x: Column, n: int, walk: int, seed: int = SEED) -> Column:
    """The permutation of 0..n-1."""
    a, b = _sides(n)
    out = _permuted(x, a, b, seed)
    if walk:
        out = F.aggregate(F.sequence(F.lit(1), F.lit(walk)), out,
                          lambda y, _: F.when(y < n, y).otherwise(_permuted(y, a, b, seed)))
    return out


def numbered(rows: DataFrame, columns: list[str], buckets: int = BUCKETS) -> tuple[DataFrame, int]:
    """The rows' ``columns`` with a gapless ``row_number`` from 0 that depends on the rows alone; their count."""
    hashed = rows.select(*columns).withColumn("_hash", F.xxhash64(*columns)).withColumn(
        "_bucket", F.pmod("_hash", F.lit(buckets)).cast("int"))
    distinct = pinned(hashed.groupBy("_bucket", "_hash", *columns).agg(F.count("*").alias("_n")))
    tallies = distinct.groupBy("_bucket").agg(F.sum("_n").alias("_rows"))       # at most ``buckets`` rows
    sums, total = [], 0
    for r in sorted(tallies.collect()):
        sums.append((r["_bucket"], total))
        total += r["_rows"]
    before = rows.sparkSession.createDataFrame(sums, "_bucket int, _before long")
    order = Window.partitionBy("_bucket").orderBy("_hash", *columns)
    first = distinct.withColumn("_first", F.sum("_n").over(order) - F.col("_n"))
    out = (first.join(F.broadcast(before), "_bucket")                            # bounded by ``buckets``
           .withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
           .select(*columns, (F.col("_before") + F.col("_first") + F.col("_copy")).alias("row_number")))
    return out, total


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Shard and slot of every document, under the law ``rows``."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (F.octet_length(text) + 16).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    out, n = numbered(rows, ["doc_id", "size", "text_crc32"])
    place = permute(F.col("row_number"), n, walk_length(spark, n, seed), seed) if n else F.col("row_number")
    return out.withColumn("_place", place).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        F.pmod("_place", F.lit(shards)).cast("int").alias("shard"),
        _div(F.col("_place"), shards).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
