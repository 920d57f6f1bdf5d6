"""Operator 9, nearest neighbours by shifted space-filling curves.

1. Rows go to bands by norm, a band for each power of 2 (from
   its half step on, so unit vectors stay together), so that a long vector
   cannot press the others together (bands at quantiles would leave it among the
   longest).  Every query asks all bands.
2. Largest inner product becomes nearness on a sphere: a vector is divided by its
   band's largest norm and gets one more component that fills it up to length 1; a
   query is divided by its own norm.  ``CURVES`` random projections to ``DIMS``
   dimensions, each scaled by the band's mean and deviation, shifted at random and
   put in Hilbert order.
3. Equal vectors are one class, which carries its ``k + 1`` smallest ids: no result
   needs more of them.  Steps 4 and 5 see classes only, so copies neither crowd a
   cell nor hide one another.
4. In every band each curve is cut into cells of equal counts at quantiles of its
   keys (a hash of the vector and the curve breaks ties).  A band that fits one
   cell is searched as a whole, without curves.  Every class goes to its cell; one
   that holds a query also to the cells around it, as many as its key window spans.
5. A cell reranks its classes for its queries by the exact inner product; the best
   ids merge per class, and every query of a class takes them but for itself.

The window is a share of the rows (``SHARE`` each way, rounded up to cells).
Vectors without structure, as in the test tables, have no order in which near
ones are neighbours, so recall needs a share, not a constant.  The work of one
query then grows with the table as a scan's would: the cells of 16 curves hold
about as many rows as the table or more (2.2 times on check_s, where 90 % of its
rows are met), so this is about a full scan by cells.  The queries of a cell with
more than ``MAX_ASKS`` are dealt to copies of it.

A cell holds at most ``MAX_CELL`` rows or so.  Vectors that are null, zero, of
another length than most, or that hold null or non-finite components take no
part; nor do rows without an id.  Repeated ids are candidates each, and count
once in a result.  A class is grouped by the vector itself; a 128-bit hash names
it afterwards.  An empty table gives an empty result.  Other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import pinned

QUERY_EVERY, K = 20, 20
CURVES, DIMS, BITS = 16, 8, 6        # 48-bit keys
SHARE = 0.03
MIN_CELL, MAX_CELL = 512, 65_536
TIE_BITS = 14
MAX_ASKS = 16_384                    # queries of one cell that one task compares, or so
HOT = 10_000                         # queries of one class that one task joins
SEED = 7


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of integer points (rows) with ``bits`` bits a coordinate; by reflected Gray codes, top bit first."""
    x = cells.astype(np.int64).copy()
    n, d = x.shape
    for level in range(bits - 1, -1, -1):
        low = (1 << level) - 1
        for i in range(d):
            on = (x[:, i] >> level) & 1 == 1
            x[on, 0] ^= low                                   # reflect
            swap = np.where(on, 0, (x[:, 0] ^ x[:, i]) & low)  # exchange
            x[:, 0] ^= swap
            x[:, i] ^= swap
    for i in range(1, d):
        x[:, i] ^= x[:, i - 1]
    turn = np.zeros(n, np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[:, d - 1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= turn[:, None]
    key = np.zeros(n, np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[:, i] >> level) & 1)
    return key


def _valid(table: DataFrame) -> DataFrame:
    """(vec_id, v): finite non-zero vectors of the most frequent length."""
    v = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.when(x == 0, 0.0).otherwise(x))   # no -0.0
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").first()
    return rows.where(F.size("v") == (sizes.size if sizes else 0))


def _norm():
    """By the largest component, so that no square leaves the range of doubles."""
    most = F.array_max(F.transform("v", F.abs))
    return most * F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + (x / most) * (x / most)))


def _classes(rows: DataFrame, every: int, k: int) -> DataFrame:
    """(ids, v, norm, a, b, ask, band): every different vector once, with its k + 1 smallest ids and whether any id is a query.

    Each task passes on k + 1 rows of a class and kind at most, so a vector that a
    third of all rows hold never meets in one task.
    """
    once = rows.select("v", "vec_id", (F.col("vec_id") % every == 0).alias("ask")).distinct()
    at = F.row_number().over(Window.partitionBy("v", "ask").orderBy("vec_id"))
    least = once.withColumn("at", at).where(F.col("at") <= k + 1)
    classes = least.groupBy("v").agg(F.slice(F.sort_array(F.collect_list("vec_id")), 1, k + 1).alias("ids"),
                                     F.max("ask").alias("ask"))
    return (classes.select("ids", "v", _norm().alias("norm"), F.xxhash64("v").alias("a"),
                           F.xxhash64(F.lit(1), "v").alias("b"), "ask")
            .withColumn("band", F.floor(F.log2("norm") + 0.5).cast("long")))


def _projections(dim: int, curves: int, dims: int) -> np.ndarray:
    """(dim + 1, curves * dims): orthonormal within a curve where that is possible."""
    rng = np.random.default_rng(SEED)
    out = []
    for _ in range(curves):
        a = rng.normal(size=(dim + 1, dims))
        out.append(np.linalg.qr(a)[0] if dims <= dim + 1 else a)
    return np.concatenate(out, 1)


def search(table: DataFrame, every: int = QUERY_EVERY, k: int = K, curves: int = CURVES, dims: int = DIMS,
           bits: int = BITS, share: float = SHARE) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every``, its ``k`` nearest found."""
    spark = table.sparkSession
    valid = _valid(table)
    rows = pinned(_classes(valid, every, k))
    facts = rows.groupBy("band").agg(
        F.count("*").alias("n"), F.max("norm").alias("most"), F.max(F.size("v")).alias("dim"),
        F.count_if("ask").alias("asks")).orderBy("band").collect()                # some 2,100 bands at most
    schema = "query_id long, rank int, vec_id long, score double"
    if not facts:
        return spark.createDataFrame([], schema)
    dim = facts[0].dim
    bands, n, most = (np.array([r[c] for r in facts]) for c in ("band", "n", "most"))
    size = np.clip((share * n).astype(np.int64), MIN_CELL, MAX_CELL)
    cells = -(-n // size)
    reach = -(-np.ceil(share * n).astype(np.int64) // size)
    used = np.where(cells > 1, curves, 1)                     # curves of a band
    first = np.concatenate([[0], np.cumsum(cells * used)])    # its first cell
    matrix = _projections(dim, curves, dims)
    shift = np.random.default_rng(SEED + 1).random((curves, dims))
    setup = spark.sparkContext.broadcast((matrix, shift))      # a few hundred kB

    def projected(v: np.ndarray, norm: np.ndarray, most: float) -> np.ndarray:
        """Rows of a band as points on the sphere, then on all curves' axes."""
        fill = np.sqrt(np.maximum(0.0, 1.0 - (norm / most) ** 2))
        return (v / most) @ setup.value[0][:-1] + fill[:, None] * setup.value[0][-1]

    def parts(batch):
        """Vectors, norms, names, whether a query, and places of the bands, of a batch of classes."""
        v = np.asarray(batch.column(1).flatten().to_numpy(zero_copy_only=False)).reshape(len(batch), dim)
        return (v, batch.column(2).to_numpy(), batch.column(3).to_numpy(), batch.column(5).to_numpy(zero_copy_only=False),
                np.searchsorted(bands, batch.column(6).to_numpy()))

    def moments(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if len(batch):
                v, norm, _, _, band = parts(batch)
                for i in np.unique(band[cells[band] > 1]).tolist():
                    p = projected(v[band == i], norm[band == i], most[i])
                    sums[i] = sums.get(i, 0) + np.stack([p.sum(0), (p * p).sum(0)])
        for i, own in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(curves * dims, i), pa.int32()),
                                              pa.array(np.arange(curves * dims), pa.int32()), pa.array(own[0]), pa.array(own[1])],
                                             ["place", "axis", "s", "q"])

    mean, wide = np.zeros((len(bands), curves * dims)), np.ones((len(bands), curves * dims))
    scale = rows.mapInArrow(moments, "place int, axis int, s double, q double").groupBy("place", "axis").agg(
        F.sum("s").alias("s"), F.sum("q").alias("q")).collect() if (cells > 1).any() else []
    for r in scale:
        mean[r.place, r.axis] = r.s / n[r.place]
        wide[r.place, r.axis] = 3.0 * max(r.q / n[r.place] - mean[r.place, r.axis] ** 2, 1e-18) ** 0.5

    def curve_keys(p: np.ndarray, names: np.ndarray, i: int) -> np.ndarray:
        """(curves, rows): keys of projected points in band ``i``."""
        side = (1 << bits) - 1
        at = np.clip((p - mean[i]) / wide[i], -1, 1) / 4 + 0.25
        out = []
        for c in range(curves):
            cells = ((at[:, c * dims:(c + 1) * dims] + 0.5 * setup.value[1][c]) * (side + 1)).astype(np.int64)
            mixed = (names.astype(np.uint64) + np.uint64(c)) * np.uint64(0x9E3779B97F4A7C15)
            tie = (mixed >> np.uint64(64 - TIE_BITS)).astype(np.int64)
            out.append((hilbert_keys(np.minimum(cells, side), bits) << TIE_BITS) | tie)
        return np.stack(out)

    def keyed(batches):
        """A row per class and curve, for bands of several cells: the key."""
        for batch in batches:
            if len(batch):
                v, norm, names, _, band = parts(batch)
                for i in np.unique(band[cells[band] > 1]).tolist():
                    on = band == i
                    for c, own in enumerate(curve_keys(projected(v[on], norm[on], most[i]), names[on], i)):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(own), i), pa.int32()), pa.array(np.full(len(own), c), pa.int32()), pa.array(own)],
                            ["place", "curve", "key"])

    cuts = {}
    several = np.flatnonzero(cells > 1).tolist()
    if several:
        found = rows.mapInArrow(keyed, "place int, curve int, key long").groupBy("curve").agg(*[
            F.percentile_approx(F.when(F.col("place") == i, F.col("key")), [j / cells[i] for j in range(1, cells[i])],
                                20_000).alias(f"cuts{i}") for i in several]).collect()
        cuts = {(i, r.curve): np.array(r[f"cuts{i}"], np.int64) for r in found for i in several}
    bounds = spark.sparkContext.broadcast(cuts)                  # a number per curve and cell

    def placed(batch, only_asks: bool = False):
        """(whether as queries, cells, places in the batch): classes to their cells, those with a query also to the cells
        around, in every band."""
        edges = bounds.value
        v, norm, names, ask, band = parts(batch)
        asks = np.flatnonzero(ask)
        sphere = (v[asks] / norm[asks, None]) @ setup.value[0][:-1]
        for i in range(len(bands)):
            here = np.flatnonzero((band == i) & (not only_asks))
            if cells[i] == 1:
                yield False, np.full(len(here), first[i]), here
                yield True, np.full(len(asks), first[i]), asks
                continue
            own = curve_keys(projected(v[here], norm[here], most[i]), names[here], i)
            asked = curve_keys(sphere, names[asks], i)
            for c in range(curves):
                base = first[i] + c * cells[i]
                yield False, base + np.searchsorted(edges[i, c], own[c], "left"), here
                mid = np.searchsorted(edges[i, c], asked[c], "left")
                for step in range(-reach[i], reach[i] + 1):
                    to = mid + step
                    on = (to >= 0) & (to < cells[i])
                    yield True, base + to[on], asks[on]

    def counted(batches):
        """Queries of each cell."""
        total = np.zeros(first[-1], np.int64)
        for batch in batches:
            if len(batch):
                for as_query, cell, _ in placed(batch, only_asks=True):
                    if as_query:
                        np.add.at(total, cell, 1)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["cell", "n"])

    # A class asks a cell once at most, so few of them need no count; full cells are fewer than one in MAX_ASKS asks.
    full = rows.mapInArrow(counted, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).where(
        F.col("n") > MAX_ASKS).collect() if sum(r.asks for r in facts) > MAX_ASKS else []
    salts = spark.sparkContext.broadcast({r.cell: -(-r.n // MAX_ASKS) for r in full})

    def dealt(batches):
        """Rows of the cells; the queries of a full cell go to several copies of its classes."""
        copies = np.ones(first[-1], np.int64)
        for cell, many in salts.value.items():
            copies[cell] = many
        for batch in batches:
            if not len(batch):
                continue
            v, _, names, *_ = parts(batch)
            sent = pa.RecordBatch.from_arrays([batch.column(3), batch.column(4), batch.column(0),
                                               pa.array([x.tobytes() for x in v], pa.binary())], ["a", "b", "ids", "v"])
            for as_query, cell, at in placed(batch):
                if as_query:
                    copy = (names[at].astype(np.uint64) % copies[cell].astype(np.uint64)).astype(np.int64)
                    if len(at):
                        yield rows_of(cell, copy, True, sent.take(pa.array(at)))
                    continue
                for copy in range(copies[cell].max(initial=0)):
                    on = copies[cell] > copy
                    yield rows_of(cell[on], np.full(on.sum(), copy), False, sent.take(pa.array(at[on])))

    def rows_of(cell, copy, ask, sent):
        return pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array(copy, pa.int64()),
                                           pa.array(np.full(len(cell), ask)), *sent.columns],
                                          ["cell", "copy", "ask", "a", "b", "ids", "v"])

    def rerank(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        ask = t.column("ask").to_numpy()
        v = np.frombuffer(b"".join(t.column("v").to_pylist()), np.float64).reshape(len(ask), dim)
        a, b = t.column("a").to_numpy()[ask], t.column("b").to_numpy()[ask]
        ids = t.column("ids").filter(pa.array(~ask)).combine_chunks()
        flat = ids.flatten().to_numpy()
        start = np.concatenate([[0], np.cumsum(pc.list_value_length(ids).to_numpy())]).astype(np.int64)
        near, asking = v[~ask], v[ask]
        out: list[tuple] = []
        for i in range(0, len(asking) if len(near) else 0, 256):
            for at, s in enumerate(asking[i:i + 256] @ near.T, i):
                names, score = nearest_ids(s, asking[at], near, flat, start, k + 1)
                out.append((np.full(len(names), a[at]), np.full(len(names), b[at]), names, score))
        none = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        cols = [np.concatenate(c) for c in zip(*out)] if out else none
        return pa.table(dict(zip(["a", "b", "vec_id", "score"], cols)))

    found = (rows.mapInArrow(dealt, "cell long, copy long, ask boolean, a long, b long, ids array<long>, v binary")
             .groupBy("cell", "copy").applyInArrow(rerank, "a long, b long, vec_id long, score double"))
    best = found.groupBy("a", "b", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("a", "b").orderBy(F.desc("score"), "vec_id"))
    near = best.withColumn("rank", rank).where(F.col("rank") <= k + 1).drop("rank")
    return _expanded(near, valid, every, k)


def nearest_ids(s: np.ndarray, q: np.ndarray, near: np.ndarray, flat: np.ndarray, start: np.ndarray, k: int):
    """The best ``k`` different ids and their scores, of classes ``near`` with ids ``flat[start[i]:start[i + 1]]``; ``s``: rough scores."""
    take = k
    while True:
        if len(s) > take:
            least = np.partition(s, len(s) - take)[len(s) - take]
            on = np.flatnonzero(s >= least - 1e-9 * max(1.0, abs(least)))
        else:
            on = np.arange(len(s))
        score = (near[on] * q).sum(1)                        # the same sum wherever a row stands
        each = start[on + 1] - start[on]
        ids = np.concatenate([flat[start[i]:start[i + 1]] for i in on])
        score = np.repeat(score, each)
        order = np.lexsort((ids, -score))
        ids, score = ids[order], score[order]
        first = np.sort(np.unique(ids, return_index=True)[1])  # an id of several classes counts once
        if len(first) >= k or len(on) == len(s):
            return ids[first[:k]], score[first[:k]]
        take *= 2


def _expanded(near: DataFrame, valid: DataFrame, every: int, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) from the answers of classes: every query takes those of its vector, without itself.

    The queries of a class with more than ``HOT`` of them are dealt to several
    copies of its answers.  The classes that are broadcast for it are fewer than
    one in ``HOT`` queries.
    """
    asked = valid.where(F.col("vec_id") % every == 0).select(
        F.xxhash64("v").alias("a"), F.xxhash64(F.lit(1), "v").alias("b"), F.col("vec_id").alias("query_id")).distinct()
    hot = F.broadcast(asked.groupBy("a", "b").agg(F.count("*").alias("n")).where(F.col("n") > HOT)
                      .select("a", "b", F.ceil(F.col("n") / HOT).alias("copies")))
    copies = F.coalesce("copies", F.lit(1))
    asked = asked.join(hot, ["a", "b"], "left").select("a", "b", "query_id", F.pmod(F.xxhash64("query_id"), copies).alias("copy"))
    near = near.join(hot, ["a", "b"], "left").select(
        "a", "b", "vec_id", "score", F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy"))
    best = (asked.join(near, ["a", "b", "copy"]).where("query_id <> vec_id")
            .groupBy("query_id", "vec_id").agg(F.max("score").alias("score")))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
