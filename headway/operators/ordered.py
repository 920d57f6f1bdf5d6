"""Ordered-row operators that never pull a frame, a trip or a group into one task.

The reference computes ``shift``/``diff`` over a whole sorted frame: the row
before or after in one *global* order, across trip borders (W1, W5, W7).  A
Spark window without ``partitionBy`` would run that in a single task, and a
window keyed by ``trip_id`` would put a hot trip in one task.  Instead:

1. ``slice_by_order`` range-partitions the frame on its total order, so each
   slice is a contiguous run of that order; a hot trip simply spans several
   slices.  The tagged frame is written to ``spark.checkpoint.dir``, as a reliable
   checkpoint (or as Parquet files: ``stored_slices``), so every branch reads the
   same slice of every row (two independently planned range exchanges could sample
   different bounds), lost executors cost nothing, and no plan stays registered in
   the session.
2. Inside a slice, ``lag``/``lead``/``max`` are ordinary windows partitioned by
   the slice id; one exchange by that id (slice k to task k) serves them all.
3. Rows at the edge of a slice are completed from *edge tables* with at most
   one or two rows per slice: their size is fixed by the slice count (a
   configuration value), not by the data, so they are broadcast.  All edge
   tables of a step come from one aggregate over the pinned base
   (``slice_ends``), never from the output of another ordered step, so plans
   do not nest.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, CalendarIntervalType, DataType, MapType, NullType, StructType,
                               UserDefinedType, VariantType)

from ..session import ensure_checkpoint_dir, partition_count

SLICE = "_slice"
SLICES_CONF = "headway.slices"       # slice count of ordered steps (default: session.partition_count)
WHILE_PINNED = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # pinned rows are small in files: a task that sorts them for its slices' ends gets a million or so
    "spark.sql.files.maxPartitionBytes": str(16 << 20),
}


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(c) for c in names]


def _ordering(order: Sequence[str]) -> Column:
    # struct comparison is field by field, nulls first: the same order as the windows
    return F.struct(*_cols(order))


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once, as a reliable checkpoint: a task for each task that wrote it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def pin(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once, as Parquet files, so every branch reads the same rows (and slice ids).

    The files are in ``spark.checkpoint.dir`` and take less than half the disk of a
    checkpoint; a branch reads the columns that it needs.  The exchanges that led to
    them are deleted as soon as they are written, the files by ``unpin``.  A frame that
    Parquet cannot hold is checkpointed.
    """
    if not _storable(df.schema):
        return checkpointed(df)
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/pinned-{uuid.uuid4().hex}"
    given = {key: spark.conf.get(key, None) for key in WHILE_PINNED}
    for key, value in WHILE_PINNED.items():
        spark.conf.set(key, value)
    try:
        # no dictionaries: most columns have too many values, and building them takes a fifth of the time
        df.write.option("compression", "zstd").option("parquet.enable.dictionary", "false").parquet(path)
    finally:
        for key, value in given.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    pinned = spark.read.schema(df.schema).parquet(path)
    pinned._pinned_at = path
    return pinned


def unpin(*frames: DataFrame) -> None:
    """Delete the files of pinned frames that no plan still to be run reads."""
    for frame in frames:
        if path := getattr(frame, "_pinned_at", None):
            sc = frame.sparkSession.sparkContext
            at = sc._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def _storable(kind: DataType) -> bool:
    """Whether Parquet holds values of this type as they are."""
    if isinstance(kind, StructType):
        names = {n.lower() for n in kind.names}
        return 0 < len(names) == len(kind.names) and all(_storable(f.dataType) for f in kind.fields)
    if isinstance(kind, ArrayType):
        return _storable(kind.elementType)
    if isinstance(kind, MapType):
        return _storable(kind.keyType) and _storable(kind.valueType)
    return not isinstance(kind, (NullType, CalendarIntervalType, UserDefinedType, VariantType))


def slice_by_order(df: DataFrame, order: Sequence[str], num_slices: int | None = None) -> DataFrame:
    """Range-partition ``df`` on ``order`` (ascending, nulls first) and tag each row with its slice.

    A task of the pinned frame holds one slice, so aggregates per slice move a row
    a task; windows take the frame ``by_slice``.
    ``order`` should be a total order (unique key) so neighbours are well defined.
    """
    return checkpointed(_tagged(df, order, num_slices))


def stored_slices(df: DataFrame, order: Sequence[str], num_slices: int | None = None) -> DataFrame:
    """``slice_by_order`` as Parquet files (see ``pin``), whose tasks read parts of slices as files are dealt."""
    return pin(_tagged(df, order, num_slices))


def _tagged(df: DataFrame, order: Sequence[str], num_slices: int | None) -> DataFrame:
    n = num_slices or slice_count(df.sparkSession)
    return (df.repartitionByRange(n, *[F.col(c).asc_nulls_first() for c in order])
            .withColumn(SLICE, F.spark_partition_id()))


def by_slice(df: DataFrame, num_slices: int | None = None) -> DataFrame:
    """Slice k to task k: windows and aggregates keyed by the slice need no other exchange.

    (A hash of the slice ids would leave some tasks empty and give others several slices.)
    """
    return df.repartitionById(num_slices or slice_count(df.sparkSession), F.col(SLICE))


def slice_count(spark) -> int:
    """``headway.slices`` if set, else the partitions that every other exchange has."""
    configured = spark.conf.get(SLICES_CONF, None)
    return int(configured) if configured else partition_count(spark)


def _slice_window(order: Sequence[str]):
    return Window.partitionBy(SLICE).orderBy(*[F.col(c).asc_nulls_first() for c in order])


# ---------------------------------------------------------------- slice ends

def slice_ends(base: DataFrame, order: Sequence[str], prev_cols: Sequence[str] = (),
               next_cols: Sequence[str] = (), group: Sequence[str] = (), value: str | None = None) -> DataFrame:
    """One aggregate pass over a sliced frame: what the edge rows of every slice need.

    Per non-empty slice (so at most ``num_slices`` rows): its last row
    (``prev_cols``), its first row (``next_cols``), and for a numeric ``value``
    the first and last ``group`` with the max ``value`` of that group inside the
    slice.  ``group`` must be a prefix of ``order``.  Every edge table below is
    derived from this one small frame.
    """
    ordering = _ordering(order)
    aggs = []
    if prev_cols:
        aggs.append(F.max_by(F.struct(*[F.col(c).alias(c) for c in prev_cols]), ordering).alias("last_row"))
    if next_cols:
        aggs.append(F.min_by(F.struct(*[F.col(c).alias(c) for c in next_cols]), ordering).alias("first_row"))
    if group:
        v = F.col(value)
        keyed = F.struct(*[F.col(g).alias(g) for g in group], v.alias("v"))
        gcols = _cols(group)
        # first group of the slice (smallest key), largest non-null value within it
        aggs.append(F.min_by(keyed, F.struct(*gcols, v.isNull(), -v)).alias("first_group"))
        # last group of the slice, largest non-null value within it
        aggs.append(F.max_by(keyed, F.struct(*gcols, v.isNotNull(), v)).alias("last_group"))
    return base.groupBy(SLICE).agg(*aggs)


def neighbour_edges(ends: DataFrame, direction: str) -> DataFrame:
    """Per slice, the neighbour of its edge row: the previous slice's last row or the next one's first row."""
    prev = _check_direction(direction)
    col, shift = ("last_row", F.lag) if prev else ("first_row", F.lead)
    # one row per non-empty slice: bounded by the slice count, so one ordered task is fine
    return ends.select(SLICE, shift(F.col(col), 1).over(Window.orderBy(SLICE)).alias("edge"))


def group_max_edges(ends: DataFrame, group: Sequence[str]) -> DataFrame:
    """Whole-frame max of every group cut by a slice edge (at most two groups per slice).

    A group continuing across an edge is the last group of one slice and the
    first (or only) group of the following ones, so the maximum over those
    entries is the group's maximum.
    """
    firsts = ends.select(*[F.col(f"first_group.{g}").alias(g) for g in group], F.col("first_group.v").alias("v"))
    lasts = ends.select(*[F.col(f"last_group.{g}").alias(g) for g in group], F.col("last_group.v").alias("v"))
    return firsts.unionByName(lasts).groupBy(*group).agg(F.max("v").alias("edge_max"))


# ---------------------------------------------------------------- applying edges

def apply_neighbour(df: DataFrame, order: Sequence[str], cols: Sequence[str], direction: str,
                    out: str, edges: DataFrame) -> DataFrame:
    """Add struct column ``out`` with ``cols`` of the previous/next row in the global order.

    ``out`` is null only for the first (prev) or last (next) row of the whole
    frame; a present neighbour is a non-null struct even when its fields are null.
    """
    prev = _check_direction(direction)
    payload = F.struct(*[F.col(c).alias(c) for c in cols])
    shift = F.lag if prev else F.lead
    local = df.withColumn(out, shift(payload, 1).over(_slice_window(order)))
    edge = f"{out}__edge"
    return (local.join(F.broadcast(edges.withColumnRenamed("edge", edge)), SLICE, "left")
            .withColumn(out, F.coalesce(F.col(out), F.col(edge)))
            .drop(edge))


def with_neighbour(base: DataFrame, order: Sequence[str], cols: Sequence[str], direction: str,
                   out: str) -> DataFrame:
    """``apply_neighbour`` with edges taken from ``base`` itself (``base`` is a sliced frame)."""
    prev = _check_direction(direction)
    ends = pin(slice_ends(base, order, prev_cols=cols if prev else (), next_cols=() if prev else cols))
    return apply_neighbour(by_slice(base), order, cols, direction, out, neighbour_edges(ends, direction))


def _check_direction(direction: str) -> bool:
    if direction not in ("prev", "next"):
        raise ValueError(f"direction must be 'prev' or 'next', got {direction!r}")
    return direction == "prev"


def apply_group_max(df: DataFrame, group: Sequence[str], value: str, out: str,
                    edges: DataFrame) -> DataFrame:
    """Add ``out`` = max(``value``) over all rows sharing ``group``."""
    edge = f"{out}__edge"
    local = df.withColumn(out, F.max(value).over(Window.partitionBy(SLICE, *group)))
    return (local.join(F.broadcast(edges.withColumnRenamed("edge_max", edge)), list(group), "left")
            .withColumn(out, F.greatest(F.col(edge), F.col(out)))
            .drop(edge))


def with_group_max(base: DataFrame, order: Sequence[str], group: Sequence[str], value: str,
                   out: str) -> DataFrame:
    ends = slice_ends(base, order, group=group, value=value)
    return apply_group_max(by_slice(base), group, value, out, group_max_edges(ends, group))


# ---------------------------------------------------------------- segmented scan

def _seams(ends: DataFrame, group: Sequence[str], combine: Sequence[Column], kept: Sequence[str] = ()) -> DataFrame:
    """Whole-frame values of the groups that slices begin (``head``) and end (``tail``) with.

    ``ends`` has a row per slice: structs ``head`` and ``tail`` with the group's
    columns and what the slice knows of it.  A group cut by slice edges is the
    tail of one slice and the head of the following ones, so ``combine``,
    aggregates over those pieces, gives its value in the whole frame.  Two rows
    per slice at most, whatever the data.
    """
    pieces = ends.select(SLICE, F.inline(F.array("head", "tail")))
    whole = pieces.groupBy(*group).agg(*combine)

    def of(side: str) -> DataFrame:
        return whole.select(F.struct(*_cols(group)).alias(f"{side}_key"),
                            F.struct(*[F.col(c) for c in whole.columns]).alias(f"{side}_whole"))

    key = {side: F.struct(*[F.col(f"{side}.{g}").alias(g) for g in group]) for side in ("head", "tail")}
    return (ends.join(of("head"), key["head"].eqNullSafe(F.col("head_key")))
            .join(of("tail"), key["tail"].eqNullSafe(F.col("tail_key")))
            .select(SLICE, *kept, F.col("head_whole").alias("_head"), F.col("tail_whole").alias("_tail")))


def _completed(group: Sequence[str], field: str, local: Column) -> Column:
    """``local``, or the whole-frame value where the row's group is its slice's first or last."""
    def same(side: str) -> Column:
        found = F.lit(True)
        for g in group:
            found = found & F.col(g).eqNullSafe(F.col(f"{side}.{g}"))
        return found

    return F.when(same("_head"), F.col(f"_head.{field}")).when(same("_tail"), F.col(f"_tail.{field}")).otherwise(local)


def segmented_scan(base: DataFrame, order: Sequence[str], following: Sequence[str], out: str,
                   group: Sequence[str] = (), value: str | None = None, out_max: str | None = None) -> DataFrame:
    """The next row's ``following`` columns as struct ``out``, and the group's largest ``value`` as ``out_max``.

    One summary row per slice (first row, border groups with their maxima) is
    aggregated from ``base``, combined in slice order, and pinned; then one
    pass over the slices applies it.  ``base`` is a sliced frame that is pinned
    (or cheap): it is read once for the summary and once for the pass, and no
    step upstream of it runs again.  ``group`` is a prefix of ``order``.
    """
    ends = pin(slice_ends(base, order, next_cols=following, group=group, value=value))     # used several times
    summary = ends.select(SLICE, F.lead("first_row").over(Window.orderBy(SLICE)).alias("_edge"),
                          *([F.col("first_group").alias("head"), F.col("last_group").alias("tail")] if group else []))
    if group:
        summary = _seams(summary, group, [F.max("v").alias("v")], kept=["_edge"])
    rows = by_slice(base).join(F.broadcast(pin(summary)), SLICE, "left")
    payload = F.struct(*[F.col(c).alias(c) for c in following])
    rows = rows.withColumn(out, F.coalesce(F.lead(payload).over(_slice_window(order)), F.col("_edge")))
    if group:
        local = F.max(value).over(Window.partitionBy(SLICE, *group))
        rows = rows.withColumn(out_max, _completed(group, "v", local)).drop("_head", "_tail")
    return rows.drop("_edge")


def with_group_ends(base: DataFrame, group: Sequence[str], order: Sequence[str], value: str,
                    out_first: str, out_last: str) -> DataFrame:
    """Add ``value`` of the first and of the last row of each ``group`` (a prefix of ``order``), nulls kept.

    ``base`` is a pinned sliced frame.  Groups inside a slice are windows of the
    slice; those that slice edges cut are completed from one summary row per slice,
    so nothing is grouped by key and joined back to detail.
    """
    whole_group = (Window.partitionBy(SLICE, *group).orderBy(*[F.col(c).asc_nulls_first() for c in order])
                   .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    local = (by_slice(base).withColumn(out_first, F.first(value).over(whole_group))
             .withColumn(out_last, F.last(value).over(whole_group)))
    piece = F.struct(*_cols(group), F.col(out_first).alias("a"), F.col(out_last).alias("z"))
    key = F.struct(*_cols(group))
    ends = pin(local.groupBy(SLICE).agg(F.min_by(piece, key).alias("head"), F.max_by(piece, key).alias("tail")))
    seams = pin(_seams(ends, group, [F.min_by("a", SLICE).alias("a"), F.max_by("z", SLICE).alias("z")]))
    return (local.join(F.broadcast(seams), SLICE, "left")
            .withColumn(out_first, _completed(group, "a", F.col(out_first)))
            .withColumn(out_last, _completed(group, "z", F.col(out_last)))
            .drop("_head", "_tail"))


# ---------------------------------------------------------------- per-group first/last/keep

def first_last_keep(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str,
                    keep_when: Column, keep_cols: Sequence[str]) -> DataFrame:
    """One aggregate pass per group (partial aggregation, so hot groups are fine).

    Returns ``group`` + ``first_<value>``/``last_<value>`` (by ``order``, null
    values kept) + struct ``kept`` with the ``keep_cols`` of the earliest row
    satisfying ``keep_when`` (null when no row does).
    """
    ordering = _ordering(order)
    kept = F.struct(*[F.col(c).alias(c) for c in keep_cols])
    return df.groupBy(*group).agg(
        F.min_by(F.col(value), ordering).alias(f"first_{value}"),
        F.max_by(F.col(value), ordering).alias(f"last_{value}"),
        F.min_by(kept, F.when(keep_when, ordering)).alias("kept"),
    )


def first_last_keep_by_slice(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str,
                             keep_when: Column, keep_cols: Sequence[str]) -> DataFrame:
    """``first_last_keep`` of a frame ``by_slice``, without another exchange.

    ``group`` followed by ``order`` is the order of the slices, so a group is in one
    slice unless slice edges cut it.  What a slice knows of its groups is pinned;
    only the cut groups, each slice's first or last, are combined, in slice order.
    """
    first, last = f"first_{value}", f"last_{value}"
    pieces = pin(first_last_keep(df, [SLICE, *group], order, value, keep_when, keep_cols))
    key = F.struct(*_cols(group))
    ends = pin(pieces.groupBy(SLICE).agg(F.min(key).alias("head"), F.max(key).alias("tail")))
    cut = (ends.select("head", F.lag("tail").over(Window.orderBy(SLICE)).alias("before"))
           .where(F.col("head").eqNullSafe(F.col("before")))
           .select(*[F.col(f"head.{g}").alias(f"_cut_{g}") for g in group]).distinct())
    is_cut = F.lit(True)
    for g in group:
        is_cut = is_cut & F.col(g).eqNullSafe(F.col(f"_cut_{g}"))
    cut = F.broadcast(cut)          # at most one group per slice edge
    whole = pieces.join(cut, is_cut).groupBy(*group).agg(
        F.min_by(first, SLICE).alias(first), F.max_by(last, SLICE).alias(last),
        F.min_by("kept", F.when(F.col("kept").isNotNull(), F.col(SLICE))).alias("kept"))
    return pieces.join(cut, is_cut, "left_anti").drop(SLICE).unionByName(whole)


# ---------------------------------------------------------------- global row number

def global_row_number(base: DataFrame, order: Sequence[str], out: str = "index") -> DataFrame:
    """0-based position of every row in the global ``order`` (``base`` is a sliced frame).

    Row number inside the slice plus the number of rows in all earlier slices;
    the per-slice counts form a table of at most ``num_slices`` rows.
    """
    counts = base.groupBy(SLICE).agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.select(
        SLICE, (F.sum("n").over(Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)))
        .alias("before"))
    local = by_slice(base).withColumn(out, F.row_number().over(_slice_window(order)) - 1)
    return (local.join(F.broadcast(offsets), SLICE, "left")
            .withColumn(out, F.col(out) + F.coalesce(F.col("before"), F.lit(0)))
            .drop("before", SLICE))
