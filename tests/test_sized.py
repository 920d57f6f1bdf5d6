"""What a task gets does not grow with the input: partitions of exchanges, files of a day, the checkpoint folder."""

import os

from pyspark.sql import functions as F

from headway import session as se
from headway.operators import ordered as od
from headway.plans import jobs
from headway.registry import QUERIES
from headway.sinks import files, tables
from headway.sources import fixtures as fx

SF = "/root/testdata/sf0.001"
BASE = 1701406800


def _lineitem(spark, folder, rows):
    spark.range(rows).select(
        F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), (F.col("id") % 50).alias("l_partkey"),
        (F.col("id") % 7).alias("l_suppkey"), F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus")).write.parquet(
        f"{folder}/lineitem.parquet")


def test_exchanges_have_partitions_by_the_stored_input(spark, scratch, monkeypatch):
    _lineitem(spark, scratch, 2000)
    stored = sum(os.path.getsize(os.path.join(at, n)) for at, _, names in os.walk(scratch) for n in names if n.endswith(".parquet"))
    monkeypatch.setattr(se, "PARTITION_BYTES", stored // 40)
    try:
        polls = QUERIES["two_day_positions"](spark, scratch)
        n = se.partition_count(spark)
        assert 40 <= n <= 41 and od.slice_count(spark) == n
        # the group step: as many tasks as partitions, not joined again
        assert polls.rdd.getNumPartitions() == n
        assert polls.count() == 2000 + sum(k % 7 in (0, 5) for k in range(2000))
        stored_in = tables.write_bucketed(polls.select("trip_id"), "sized_polls", f"{scratch}/sized", ("trip_id",))
        assert stored_in.count() == polls.count()
        assert len({f.split("_")[-1].split(".")[0] for f in os.listdir(f"{scratch}/sized") if f.endswith(".parquet")}) > 30
    finally:
        spark.sql("DROP TABLE IF EXISTS sized_polls")
        monkeypatch.undo()
        se.size_exchanges(spark, SF)
    assert se.sized_partitions(spark) is None and od.slice_count(spark) == 4


def test_a_session_keeps_its_larger_number(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        se.size_exchanges(spark, SF)
        assert se.sized_partitions(spark) is None and se.partition_count(spark) == 64
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_checkpoint_folders_do_not_nest(spark):
    first = se.ensure_checkpoint_dir(spark)
    for _ in range(3):
        od.pin(spark.range(3))
    assert se.ensure_checkpoint_dir(spark) == first == spark.sparkContext.getCheckpointDir()


def _files(folder):
    return [f for _, _, names in os.walk(folder) for f in names if f.endswith(".parquet")]


def test_a_large_day_is_compacted_by_many_tasks(spark, scratch, monkeypatch):
    monkeypatch.setattr(files, "ROWS_PER_FILE", 100)
    polls = spark.range(1000).select((F.lit(BASE) + F.col("id") % 3 * 1800).alias("timefetch"), F.col("id").alias("bike"))
    jobs.land_rows(polls, f"{scratch}/landed")
    assert jobs.compact_landed_day(spark, f"{scratch}/landed", f"{scratch}/days", "2023-12-01") == 10
    assert sorted(r.bike for r in spark.read.parquet(f"{scratch}/days").collect()) == list(range(1000))


def test_polls_by_day_have_files_by_their_rows(spark, scratch, monkeypatch):
    _lineitem(spark, scratch, 2000)
    plain = sorted(map(tuple, QUERIES["day_partitions"](spark, scratch).collect()))
    asked, real = [], files.write_day_partitioned

    def write(df, path, *a, **k):
        asked.append(k.get("files_per_day"))
        real(df, path, *a, **k)

    monkeypatch.setattr(files, "ROWS_PER_FILE", 100)
    monkeypatch.setattr(files, "write_day_partitioned", write)
    assert sorted(map(tuple, QUERIES["day_partitions"](spark, scratch).collect())) == plain
    assert asked == [20, None]
    assert files.file_count(0, 2) == files.file_count(200, 2) == 2 and files.file_count(201) == 3
