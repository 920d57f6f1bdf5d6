"""Operator 13, mixing sources to target weights by pivotal dependent rounding (DataFrame functions only).

Targets: sources in the order of their names (nulls last) weigh ``WEIGHTS``,
repeating, and share ``SHARE`` of all words.  A source takes ``MOST`` times its
words at most; what is above is shared again by weight among the others, round
by round, until none is above.  Each round adds up one row per source, and sums
alone reach the driver.

Rounding: every document of a source starts with the same copies, a whole
number and a fraction.  The fractions, as words (``mass`` = fraction x size),
meet in pairs: mass moves one way or the other, by chance and without changing
its expectation, until one of the two is all or nothing.  The pair's words are
the same before and after, so a source's words are kept exactly until its last
fraction, which goes to the nearer side: a source ends within half a document
of its target.

Reduction tree: documents of a source are numbered by falling size from range
slices; each run of ``RUN`` is reduced in order to one fraction, and these are
reduced again, level by level.  So a source that holds a third of all rows is
many small runs.  The chance is a keyed hash of places and sources: a rerun
agrees, whatever the partitions.

A null or empty text, or one of white space, has size 0 and takes 0.  A null
source is a source.  Null ids are ids like others, repeated rows are documents
of their own (they meet in any order, with equal rows in all).  Without words
all targets are 0; an empty table gives an empty result.  Texts are counted
whole.  Columns other than doc_id, text and source are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import numbered_within, pinned

WEIGHTS = (3, 1, 2)
SHARE = (3, 2)           # of all words: three halves
MOST = 2                 # times a source's words
RUN = 64                 # fractions that one row of a level reduces
SEED = 20250613
ITEM = "struct<i:bigint,doc_id:bigint,size:bigint,mass:double>"


def word_count(text: Column) -> Column:
    """Runs of characters other than space and U+0009 to U+000D; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """Text key of a source, never null, by code point with null last."""
    return F.coalesce(F.concat(F.lit("0"), source.cast("string")), F.lit("1"))


def targets(sources: DataFrame) -> DataFrame:
    """(source, source_size) with ``weight``, ``target``, whole copies and the fraction left, by shared excess."""
    sliced, table = numbered_within(sources.withColumn("_all", F.lit("")), "_all", [F.col("source").asc()])
    place = (F.col("_at") + F.col("_shift")) % len(WEIGHTS)
    weighed = pinned(sliced.join(table, ["_all", "_slice"]).select(
        "source", "source_size", F.element_at(F.array(*map(F.lit, WEIGHTS)), (place + 1).cast("int")).cast("long").alias("weight")))
    first = weighed.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    size, weight = first["size"] or 0, first["weight"] or 0
    wide = "decimal(38,0)"

    def above(rest: int, share: int) -> Column:
        """Whether weight x rest / (2 x share), the source's part, is more than it may take."""
        return (F.col("weight").cast("decimal(4,0)") * F.lit(rest).cast("decimal(30,0)")
                > F.col("source_size").cast("decimal(19,0)") * F.lit(SHARE[1] * MOST * share).cast("decimal(18,0)"))

    full, capped, share = F.lit(False), 0, weight
    while True:         # each round caps a source at least; sizes are integers, so the rounds are few
        rest = SHARE[0] * size - SHARE[1] * MOST * capped
        now = above(rest, share)
        found = weighed.where(now).agg(F.sum(F.col("source_size").cast(wide)).alias("s"), F.sum("weight").alias("w")).first()
        s, w = int(found["s"] or 0), found["w"] or 0
        full = now
        if (s, weight - w) == (capped, share) or w == weight:
            break
        capped, share = s, weight - w
    part = F.col("weight") * F.lit(float(rest)) / F.lit(float(SHARE[1] * share or 1))
    most = (MOST * F.col("source_size")).cast("double")
    copies = weighed.withColumn("target", F.when(full, most).otherwise(part))
    whole = F.when(full, F.lit(MOST)).when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    left = F.when(F.col("source_size") > 0,
                  (F.col("target") - F.col("whole") * F.col("source_size")) / F.col("source_size")).otherwise(0.0)
    return copies.withColumn("whole", whole.cast("int")).withColumn("fraction", left)


def chance(*parts: Column) -> Column:
    """A number from 0 to 1 (excluded) that the parts alone decide."""
    text = F.concat_ws(":", F.lit(str(SEED)), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def _merge(source: Column, level: int):
    """One pairing: the fraction that goes on, and the document decided (taken once more or not)."""
    def item(x: Column, mass: Column) -> Column:
        return F.struct(x["i"].alias("i"), x["doc_id"].alias("doc_id"), x["size"].alias("size"), mass.alias("mass"))

    def done(x: Column, more: int) -> Column:
        return F.array(F.struct(x["doc_id"].alias("doc_id"), x["size"].alias("size"), F.lit(more).alias("more")))

    def step(state: Column, b: Column) -> Column:
        a = state["rest"]
        room_a, room_b = a["size"] - a["mass"], b["size"] - b["mass"]
        up, down = F.least(room_a, b["mass"]), F.least(a["mass"], room_b)
        to_a = chance(source, F.lit(level), a["i"], b["i"]) * (up + down) < down
        rest = (F.when(to_a & (room_a <= b["mass"]), item(b, b["mass"] - up))
                .when(to_a, item(a, a["mass"] + up))
                .when(a["mass"] <= room_b, item(b, b["mass"] + down))
                .otherwise(item(a, a["mass"] - down)))
        decided = (F.when(to_a & (room_a <= b["mass"]), done(a, 1)).when(to_a, done(b, 0))
                   .when(a["mass"] <= room_b, done(a, 0)).otherwise(done(b, 1)))
        return F.struct(rest.alias("rest"), F.concat(state["decided"], decided).alias("decided"))

    return step


def reduce_runs(items: DataFrame, level: int, run: int = RUN) -> DataFrame:
    """Each run of ``run`` fractions of a source as one row: the fraction ``rest`` and the ``decided`` documents.

    ``items`` has the source's columns and one ITEM per row; the rows of a run are at most ``run``.
    """
    keys = [c for c in items.columns if c != "item"]
    runs = (items.withColumn("_run", F.floor(F.col("item.i") / F.lit(run)))
            .groupBy(*keys, "_run").agg(F.sort_array(F.collect_list("item")).alias("items")))
    start = F.struct(F.col("items")[0].alias("rest"),
                     F.array().cast("array<struct<doc_id:bigint,size:bigint,more:int>>").alias("decided"))
    rest = F.slice("items", F.lit(2), F.lit(run))
    return runs.select(*keys, "_run", F.aggregate(rest, start, _merge(F.col("source"), level)).alias("_made")).select(
        *keys, "_run", "_made.rest", "_made.decided")


def mix(docs: DataFrame, run: int = RUN) -> DataFrame:
    """The words taken of every document, whole copies of it, so that sources come to their targets."""
    sized = docs.select(source_key(F.col("source")).alias("source"), F.col("doc_id").cast("long").alias("doc_id"),
                        word_count(F.col("text")).alias("size"))
    sliced, table = numbered_within(sized, "source", [F.col("size").desc(), F.col("doc_id").asc_nulls_first()],
                                    [("source_size", F.col("size"))])
    wanted = pinned(targets(table.select("source", "source_size").distinct()))
    known = ["source", "source_size", "target", "whole"]
    rows = (sliced.join(table.select("source", "_slice", "_shift", "_n").join(wanted, "source"), ["source", "_slice"])
            .withColumn("i", F.col("_at") + F.col("_shift")))
    open_ = (F.col("fraction") > 0) & (F.col("size") > 0)
    most = table.agg(F.max("_n")).first()[0] or 0
    items = rows.where(open_).select(
        *known, F.struct("i", "doc_id", "size", (F.col("fraction") * F.col("size")).alias("mass")).cast(ITEM).alias("item"))

    def result(decided: DataFrame) -> DataFrame:
        return decided.select("doc_id", "size", "source_size", "target", ((F.col("whole") + F.col("more")) * F.col("size")).alias("taken"))

    out, level = result(rows.where(~open_).withColumn("more", F.lit(0))), 0
    while most > 1:
        made = pinned(reduce_runs(items, level, run))
        out = out.unionByName(result(made.select(*known, F.explode("decided").alias("_d")).select(*known, "_d.*")))
        items = made.select(*known, F.struct(F.col("_run").alias("i"), F.col("rest.doc_id").alias("doc_id"),
                                             F.col("rest.size").alias("size"), F.col("rest.mass").alias("mass")).alias("item"))
        most, level = -(-most // run), level + 1
    last = items.select(*known, "item.*").withColumn("more", (2 * F.col("mass") >= F.col("size")).cast("int"))
    return out.unionByName(result(last))
