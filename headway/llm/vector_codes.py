"""Operator 12, vector code compression: codebooks of vector parts, trained with anchors-hierarchy metric trees.

Vectors become integers (floor of ``SCALE`` times each component) and are cut
into ``PARTS`` equal parts, each with a codebook of ``ENTRIES`` entries that a
few rounds of assignment and averaging improve.  All results are exact integers,
so neither the blocks nor the trees below change them.

* Rows are taken in blocks of at most ``BLOCK`` vectors of a task.  For every
  part a block gets a metric tree, built middle-out: about sqrt(n) anchors first
  (each the point furthest from the anchors so far, taking over the points that
  are nearer to it; by the triangle inequality only points beyond half the
  distance between anchors are looked at), the two anchors with the smallest
  ball around both are joined again and again into a tree, and large anchors are
  split the same way.  Each ball caches its points' sum and count.  Blocks and
  trees are checkpointed once; every round reads them.
* A round goes down the trees, level by level, with lists of candidate entries
  inherited from the ball above.  An entry leaves a ball's list when all points
  of the ball are nearer to another one.  A ball with one entry left is owned by
  it as a whole: its cached sum and count are added, its points are not looked
  at.  Only small balls compare their points with the entries left.
* Tasks send sums per part, entry and place: a fixed number, whatever the rows,
  added up by a partial aggregate.  Codebooks (``PARTS`` x ``ENTRIES`` entries)
  are the only thing on the driver.

Rows whose vector is null or holds a null or a number that is not finite are
dropped.  The length is that of most vectors among those that ``PARTS`` divides
(the longer at a tie); vectors of other lengths, empty ones too, stay with a null
code and null error.  With fewer than ``ENTRIES`` vectors every one is an entry.
Null ids come last when entries are chosen; rows of equal ids are ordered by
their integers.  Blocks with components so large that sums of squares might not fit
into 64 bits are compared point by point in unbounded integers; errors beyond a
long are the largest long.  Equal vectors, repeated rows and equal entries
are allowed (the lower index wins).  An empty table gives an empty result.
Columns other than vec_id, embedding and label are ignored.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import pinned

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
BLOCK = 4096         # vectors in memory at once, times their length
LEAF = 48            # points of a ball that is not split
SALTS = 32           # groups that the rows of one label are dealt over
LIMB = 40            # bits of the pieces in which sums travel
LONG = (1 << 63) - 1


# ---------------------------------------------------------------- integers

def to_integers(vectors: np.ndarray) -> np.ndarray:
    """floor(SCALE x) of finite doubles, as 64-bit integers, or as Python integers where they do not fit."""
    small = np.abs(vectors) < 2.0 ** 52 / SCALE
    if small.all():
        return np.floor(vectors * SCALE).astype(np.int64)
    out = np.empty(vectors.shape, object)
    for at, x in np.ndenumerate(vectors):
        out[at] = math.floor(x * SCALE) if small[at] else math.floor(x) * SCALE + math.floor((x - math.floor(x)) * SCALE)
    return out


def bound(dims: int) -> int:
    """Integers below it in size: squared distances over ``dims`` places fit into 64 bits."""
    return math.isqrt((1 << 60) // max(dims, 1))


def _large(x: np.ndarray, dims: int) -> bool:
    return any(abs(v) >= bound(dims) for v in x.ravel()) if x.dtype == object else int(np.abs(x).max()) >= bound(dims)


# ---------------------------------------------------------------- trees

def _anchors(points: np.ndarray, want: int) -> np.ndarray:
    """Each point's anchor (numbers from 0) among at most ``want``; fewer if points are equal."""
    owner = np.zeros(len(points), np.int64)
    pivots = [points[0]]
    far = np.sqrt(((points - points[0]) ** 2).sum(1))
    while len(pivots) < want:
        new = int(far.argmax())          # the furthest point of the anchor with the largest radius
        if far[new] == 0:
            break
        between = np.sqrt(((np.array(pivots) - points[new]) ** 2).sum(1))
        may = np.flatnonzero(far > between[owner] / 2)
        dist = np.sqrt(((points[may] - points[new]) ** 2).sum(1))
        nearer = dist < far[may]
        taken = may[nearer]
        owner[taken], far[taken] = len(pivots), dist[nearer]
        pivots.append(points[new])
    return owner


class _Growing:
    """Balls over a block's points of one part, the root last."""

    def __init__(self, x: np.ndarray):
        self.points = x.astype(np.float64)
        self.x = x
        self.nodes: list[tuple] = []     # (members, left, right, centre, radius, sum)
        self._grow(np.arange(len(x)))

    def _ball(self, members: np.ndarray, left: int = -1, right: int = -1) -> int:
        total = self.x[members].sum(0)
        centre = total / len(members)
        radius = np.sqrt(((self.points[members] - centre) ** 2).sum(1).max())
        self.nodes.append((members, left, right, centre, radius, total))
        return len(self.nodes) - 1

    def _grow(self, members: np.ndarray) -> int:
        if len(members) <= LEAF:
            return self._ball(members)
        owner = _anchors(self.points[members], math.isqrt(len(members)))
        number = int(owner.max()) + 1
        if number == 1:                  # all points are equal
            return self._ball(members)
        return self._join([self._grow(members[owner == k]) for k in range(number)])

    def _join(self, balls: list[int]) -> int:
        """Middle-out: the two balls with the smallest ball around both become one, until one is left."""
        alive = list(balls)
        centre = np.array([self.nodes[b][3] for b in alive])
        radius = np.array([self.nodes[b][4] for b in alive])
        cost = np.sqrt(((centre[:, None] - centre[None]) ** 2).sum(2)) + radius[:, None] + radius[None]
        np.fill_diagonal(cost, np.inf)
        for _ in range(len(alive) - 1):
            a, b = sorted(divmod(int(cost.argmin()), len(cost)))
            node = self._ball(np.concatenate([self.nodes[alive[a]][0], self.nodes[alive[b]][0]]), alive[a], alive[b])
            alive[a] = node
            cost[b, :] = cost[:, b] = np.inf
            centre[a], radius[a] = self.nodes[node][3], self.nodes[node][4]
            own = np.sqrt(((centre - centre[a]) ** 2).sum(1)) + radius + radius[a]
            own[np.isinf(cost[a])] = np.inf
            cost[a, :] = cost[:, a] = own
        return node


def metric_tree(x: np.ndarray) -> SimpleNamespace:
    """The tree over integer points: arrays by node (the root last); ``order`` lists the points ball by ball."""
    nodes = _Growing(x).nodes
    starts, leaves = np.zeros(len(nodes), np.int64), []
    stack = [(len(nodes) - 1, 0)]
    while stack:
        node, at = stack.pop()
        starts[node] = at
        members, left, right = nodes[node][:3]
        if left < 0:
            leaves.append((at, members))
        else:
            stack += [(left, at), (right, at + len(nodes[left][0]))]
    column = [np.array([n[k] for n in nodes]) for k in range(1, 6)]
    return SimpleNamespace(
        order=np.concatenate([m for _, m in sorted(leaves, key=lambda o: o[0])]).astype(np.int32), start=starts,
        count=np.array([len(n[0]) for n in nodes]), left=column[0], right=column[1], centre=column[2], radius=column[3], sum=column[4])


def owners(tree: SimpleNamespace, entries: np.ndarray):
    """How the balls fall to the entries: (node, entry) pairs owned whole, and (node, entries left) of small balls."""
    centres = entries.astype(np.float64)
    _, first = np.unique(entries, axis=0, return_index=True)      # of equal entries the lowest index
    lists = np.sort(first)
    nodes, sizes, listed = np.array([len(tree.left) - 1]), np.array([len(lists)]), lists
    owned, small = [], []
    while len(nodes):
        starts = np.cumsum(sizes) - sizes
        at = np.repeat(np.arange(len(nodes)), sizes)
        dist = np.sqrt(((tree.centre[nodes][at] - centres[listed]) ** 2).sum(1))
        least = np.minimum.reduceat(dist, starts)
        reach = least + 2 * tree.radius[nodes]
        near = dist <= (reach + 1e-6 * (1 + reach))[at]           # the slack is far above rounding errors
        listed, at = listed[near], at[near]
        sizes = np.bincount(at, minlength=len(nodes))
        starts = np.cumsum(sizes) - sizes
        whole = sizes == 1
        owned += zip(nodes[whole].tolist(), listed[starts[whole]].tolist())
        leaf = ~whole & (tree.left[nodes] < 0)
        small += [(int(nodes[k]), listed[starts[k]:starts[k] + sizes[k]]) for k in np.flatnonzero(leaf)]
        inner = np.flatnonzero(~whole & ~leaf)
        passed = [listed[starts[k]:starts[k] + sizes[k]] for k in inner]
        nodes = np.concatenate([tree.left[nodes[inner]], tree.right[nodes[inner]]])
        sizes = np.tile(sizes[inner], 2)
        listed = np.concatenate(passed * 2) if passed else lists[:0]
    return owned, small


def nearest_entries(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Index of each point's nearest entry, the lower at a tie."""
    if x.dtype != object and entries.dtype != object:
        return ((x[:, None, :] - entries[None]) ** 2).sum(2).argmin(1)
    return np.array([min(range(len(entries)), key=lambda e: (sum((int(a) - int(b)) ** 2 for a, b in zip(p, entries[e])), e))
                     for p in x], np.int64)


def assigned(x: np.ndarray, tree: SimpleNamespace | None, entries: np.ndarray) -> np.ndarray:
    """Every point's nearest entry, by the tree if there is one."""
    if tree is None:
        return nearest_entries(x, entries)
    codes = np.zeros(len(x), np.int64)
    owned, small = owners(tree, entries)
    for node, entry in owned:
        codes[tree.order[tree.start[node]:tree.start[node] + tree.count[node]]] = entry
    for node, left in small:
        points = tree.order[tree.start[node]:tree.start[node] + tree.count[node]]
        codes[points] = left[nearest_entries(x[points], entries[left])]
    return codes


def summed(x: np.ndarray, tree: SimpleNamespace | None, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and counts of the points by their nearest entry; whole balls by their cached values."""
    kind = object if tree is None else np.int64
    sums, counts = np.zeros(entries.shape, kind), np.zeros(len(entries), np.int64)
    if tree is None:
        codes = nearest_entries(x, entries)
        for k, point in zip(codes.tolist(), x):
            sums[k] += point.astype(object)
            counts[k] += 1
        return sums, counts
    owned, small = owners(tree, entries)
    for node, entry in owned:
        sums[entry] += tree.sum[node]
        counts[entry] += tree.count[node]
    for node, left in small:
        points = tree.order[tree.start[node]:tree.start[node] + tree.count[node]]
        codes = left[nearest_entries(x[points], entries[left])]
        np.add.at(sums, codes, x[points])
        np.add.at(counts, codes, 1)
    return sums, counts


# ---------------------------------------------------------------- blocks

def _block(ids: list, labels: list, vectors: list, parts: int) -> bytes:
    x = to_integers(np.array(vectors, np.float64))
    large, width = _large(x, x.shape[1]), x.shape[1] // parts
    kinds = (t for t in (np.int16, np.int32, np.int64) if np.abs(x).max() <= np.iinfo(t).max)
    x = x.astype(object if large else next(kinds))
    trees = [None if large else metric_tree(x[:, k * width:(k + 1) * width].astype(np.int64)) for k in range(parts)]
    return pickle.dumps((ids, labels, x, trees), protocol=5)


def blocks_of(rows: DataFrame, parts: int = PARTS, block: int = BLOCK) -> DataFrame:
    """(vec_id, label, vector) rows of one length as blocks with their trees."""
    def collect(batches):
        ids, labels, vectors = [], [], []
        for batch in batches:
            flat = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            for i, label, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), flat.reshape(len(batch) or 1, -1)):
                ids.append(i), labels.append(label), vectors.append(v)
                if len(ids) == block:
                    yield pa.RecordBatch.from_arrays([pa.array([_block(ids, labels, vectors, parts)], pa.binary())], ["block"])
                    ids, labels, vectors = [], [], []
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array([_block(ids, labels, vectors, parts)], pa.binary())], ["block"])

    return rows.mapInArrow(collect, "block binary")


def _opened(batches):
    """Blocks one at a time: ids, labels, integers, trees."""
    for batch in batches:
        for value in batch.column(0):
            yield pickle.loads(value.as_py())


def _books(codebooks: list[list[list[int]]], large: bool, dims: int) -> tuple[list[np.ndarray], bool]:
    """Codebooks as arrays, and whether a block must do without trees for them."""
    books = [np.array(b, object) for b in codebooks]
    large = large or any(_large(b, dims) for b in books)
    return [b if large else b.astype(np.int64) for b in books], large


def _limbs(value: int):
    """(number, piece) of an integer in pieces of LIMB bits, each with the integer's sign."""
    sign, value, k = (-1 if value < 0 else 1), abs(value), 0
    while value:
        if value & ((1 << LIMB) - 1):
            yield k, sign * (value & ((1 << LIMB) - 1))
        value, k = value >> LIMB, k + 1


def _round(blocks: DataFrame, codebooks: list[list[list[int]]]) -> list[list[list[int]]]:
    """Codebooks with every used entry replaced by the floor of its parts' mean."""
    parts, width = len(codebooks), len(codebooks[0][0])

    def totals(batches):
        sums = counts = None
        for _, _, x, trees in _opened(batches):
            books, large = _books(codebooks, x.dtype == object, parts * width)
            if sums is None:
                sums = [np.zeros(b.shape, object) for b in books]
                counts = [np.zeros(len(b), np.int64) for b in books]
            for k in range(parts):
                own = x[:, k * width:(k + 1) * width]
                s, c = summed(own if large else own.astype(np.int64), None if large else trees[k], books[k])
                sums[k] += s.astype(object)
                counts[k] += c
        rows = []
        for k in range(parts if sums else 0):
            for e in np.flatnonzero(counts[k]).tolist():
                rows.append((k, e, -1, 0, int(counts[k][e])))
                rows += [(k, e, p, limb, piece) for p in range(width) for limb, piece in _limbs(int(sums[k][e][p]))]
        if rows:
            types = [pa.int32()] * 4 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                             ["part", "entry", "place", "limb", "value"])

    found = (blocks.mapInArrow(totals, "part int, entry int, place int, limb int, value long")
             .groupBy("part", "entry", "place", "limb").agg(F.sum("value").alias("value")).collect())   # a codebook's size
    sums: dict[tuple, int] = {}
    for r in found:
        key = (r["part"], r["entry"], r["place"])
        sums[key] = sums.get(key, 0) + (r["value"] << (LIMB * r["limb"]))
    return [[[sums.get((k, e, p), 0) // sums[k, e, -1] for p in range(width)] if (k, e, -1) in sums else entry
             for e, entry in enumerate(book)] for k, book in enumerate(codebooks)]


def _coded(blocks: DataFrame, codebooks: list[list[list[int]]]) -> DataFrame:
    """(vec_id, label, code, error) of every vector of the blocks."""
    parts, width = len(codebooks), len(codebooks[0][0])

    def code(batches):
        for ids, labels, x, trees in _opened(batches):
            books, large = _books(codebooks, x.dtype == object, parts * width)
            codes, errors = np.zeros((len(ids), parts), np.uint8), np.zeros(len(ids), object if large else np.int64)
            for k in range(parts):
                own = x[:, k * width:(k + 1) * width]
                own = own.astype(object) if large else own.astype(np.int64)
                codes[:, k] = at = assigned(own, None if large else trees[k], books[k])
                errors += ((own - books[k][at]) ** 2).sum(1)
            text = codes.tobytes().hex()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(labels, pa.string()),
                 pa.array([text[k:k + 2 * parts] for k in range(0, len(text), 2 * parts)], pa.string()),
                 pa.array([min(int(e), LONG) for e in errors], pa.int64())], ["vec_id", "label", "code", "error"])

    return blocks.mapInArrow(code, "vec_id long, label string, code string, error long")


# ---------------------------------------------------------------- the operator

def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label as text, vector) of rows whose vector is there and holds finite numbers only."""
    v = F.col("embedding")
    infinite = F.lit(float("inf"))
    return vectors.where(v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == infinite))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
        v.cast("array<double>").alias("vector"))


def common_length(rows: DataFrame, parts: int = PARTS) -> int:
    """The length of most vectors that ``parts`` divides; 0 if there is none."""
    n = F.size("vector")
    found = rows.where((n > 0) & (n % parts == 0)).groupBy(n.alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return found["n"] if found else 0


def first_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> list[list[list[int]]]:
    """The parts of the vectors with the smallest ids, ascending: at most ``entries`` rows."""
    chosen = rows.orderBy(F.col("vec_id").asc_nulls_last(), F.transform("vector", lambda x: F.floor(x * SCALE))).limit(entries).collect()
    x = to_integers(np.array([r["vector"] for r in chosen], np.float64)).tolist()
    width = len(x[0]) // parts
    return [[row[k * width:(k + 1) * width] for row in x] for k in range(parts)]


def codebook_digest(codebooks: list[list[list[int]]]) -> str:
    return hashlib.sha256(",".join(str(v) for book in codebooks for entry in book for v in entry).encode()).hexdigest()


def train(blocks: DataFrame, codebooks: list[list[list[int]]], rounds: int = ROUNDS) -> list[list[list[int]]]:
    for _ in range(rounds):
        codebooks = _round(blocks, codebooks)
    return codebooks


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """Code and error of every usable vector, the error of its label, and the digest of the trained codebooks."""
    rows = usable(vectors)
    dims = common_length(rows, parts)
    if not dims:
        return rows.select("vec_id", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"),
                           F.lit(None).cast("long").alias("label_error"), F.lit(None).cast("string").alias("codebooks_sha256"))
    same = rows.where(F.size("vector") == dims)
    blocks = pinned(blocks_of(same, parts))
    codebooks = train(blocks, first_codebooks(same, parts, entries), rounds)
    others = rows.where(F.size("vector") != dims).select("vec_id", "label", F.lit(None).cast("string").alias("code"),
                                                         F.lit(None).cast("long").alias("error"))
    coded = pinned(_coded(blocks, codebooks).unionByName(others).withColumn(
        "label", F.coalesce(F.concat(F.lit("+"), "label"), F.lit("-"))).withColumn(
        "_salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int")))
    totals = (coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(19,0)")).alias("_sum"))
              .select("label", F.when(F.col("_sum") > LONG, F.lit(LONG)).otherwise(F.col("_sum").cast("long")).alias("label_error"),
                      F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")))
    return coded.join(totals, ["label", "_salt"]).select(
        "vec_id", "code", "error", "label_error", F.lit(codebook_digest(codebooks)).alias("codebooks_sha256"))
