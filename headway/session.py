"""Session settings the engine relies on.

Every job pins the session time zone to UTC: service-day clocks are turned into
epoch seconds with an explicit zone (see ``functions.clock``), so the session
zone must never leak into arithmetic.  AQE stays on so skewed join partitions
are split at run time and small shuffles are coalesced.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the engine depends on to an existing session."""
    for key, value in ENGINE_CONF.items():
        spark.conf.set(key, value)
    return spark


#: Stored input for each partition of an exchange: rows take many times their Parquet size in a task.
PARTITION_BYTES = 8 << 20
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def size_exchanges(spark: SparkSession, sf_dir: str) -> None:
    """As many partitions at exchanges as the stored input needs, so that a task's share does not grow with it.

    A number that the session was started with, or its shuffle partitions if they are
    more, stays.  Only the listing of the tables is read.
    """
    listed = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
              .option("recursiveFileLookup", "true").load(sf_dir))
    stored = listed.agg(F.sum("length")).first()[0] or 0
    given = spark.sparkContext.getConf().get(INITIAL_PARTITIONS, None)
    needed = -(-stored // PARTITION_BYTES)
    if needed > int(given or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(INITIAL_PARTITIONS, str(needed))
    elif given:
        spark.conf.set(INITIAL_PARTITIONS, given)
    else:
        spark.conf.unset(INITIAL_PARTITIONS)


def sized_partitions(spark: SparkSession) -> int | None:
    """The number that ``size_exchanges`` found, if it is more than the shuffle partitions."""
    sized = int(spark.conf.get(INITIAL_PARTITIONS, None) or 0)
    return sized if sized > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def partition_count(spark: SparkSession) -> int:
    """Partitions of an exchange whose number is given: the sized number, at least the shuffle partitions."""
    return sized_partitions(spark) or int(spark.conf.get("spark.sql.shuffle.partitions"))


def local_session(cores: int | str = 8, shuffle_partitions: int | None = None,
                  app: str = "headway") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    parts = shuffle_partitions or (cores if isinstance(cores, int) else 8)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in ENGINE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; only when nothing is set (local
    tests, the bench) a fresh scratch folder is created.
    """
    sc = spark.sparkContext
    if current := sc.getCheckpointDir():
        return current                  # set again, it would get a folder within the folder each time
    current = sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            # executors would each write to their own disk: refuse instead
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        current = tempfile.mkdtemp(prefix="headway-ckpt-")
    sc.setCheckpointDir(current)
    return current
