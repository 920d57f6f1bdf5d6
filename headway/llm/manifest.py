"""Operator 11, Merkle manifest of a dataset by sibling-shift self-joins (DataFrame functions only).

Each row is a leaf, each group a tree of its leaves, and the groups' subroots are
the leaves of one tree on top.  No task holds a tree or a level:

* A node is (tree, index, digest).  Indexes are places within the tree by id,
  found from range slices, so a large group is spread over all of them.
* Up: the rows in slot zero of their run compute their siblings' indices
  (``index XOR 1`` for binary trees, slot offsets otherwise) and meet them by an
  equijoin of the level with itself; each then emits its parent.  A level is
  checkpointed, with the digests of its runs, and is 1 / arity of the one below.
* Down: each run finds its parent's run by the computed index, and takes over
  the siblings on the way to the root.  Leaves join the lowest runs, so the
  longest rows (a path of levels x (arity - 1) digests) are shuffled for
  1 / arity of the leaves only.

A null field is ``-`` in a leaf, an empty text ``0:``; texts are hashed whole.
Rows without a group form the first tree.  Null ids come first, and count as the
empty text when rows to tamper with are chosen; rows of equal ids are ordered by
leaf, so repeated rows are leaves of their own and results do not depend on
the partitions.  An empty table gives an empty result.  Columns other than the
fields and the group are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import fold, group_key, numbered_within, pinned

ARITY = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: One entry per level from a node to the root: the digests left of it in its run, joined, and those right of it.
PATH = "array<struct<left:string,right:string>>"


def digest(text: Column) -> Column:
    """Lowercase hex sha256 of UTF-8 text."""
    return F.sha2(text.cast("binary"), 256)


def leaf_digest(values: list[Column]) -> Column:
    """Digest of a row: ``-`` for a null, else byte count, colon, value."""
    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest(F.concat(*[field(v) for v in values]))


def siblings(index: Column, n: Column, arity: int) -> Column:
    """Indices of the run that a slot-zero node opens on a level of ``n`` nodes, itself included."""
    if arity == 2:
        return F.filter(F.array(index, index.bitwiseXOR(F.lit(1))), lambda i: i < n)
    return F.sequence(index, F.least(index + (arity - 1), n - 1))


def _div(x: Column, by: int) -> Column:
    return F.floor(x / F.lit(by)) if by & (by - 1) else F.shiftright(x, by.bit_length() - 1)


def _parents(nodes: DataFrame, arity: int) -> DataFrame:
    """One level up: (tree, i, n, digests of the run, digest)."""
    zero = nodes.where(F.pmod("i", F.lit(arity)) == 0).select(
        "tree", "n", _div(F.col("i"), arity).alias("run"), F.explode(siblings(F.col("i"), F.col("n"), arity)).alias("i"))
    met = zero.join(nodes.select("tree", "i", "digest"), ["tree", "i"])
    runs = met.groupBy("tree", "run", "n").agg(F.sort_array(F.collect_list(F.struct("i", "digest"))).alias("run_nodes"))
    digests = F.col("run_nodes.digest")
    return runs.select("tree", F.col("run").alias("i"), _div(F.col("n") + (arity - 1), arity).alias("n"),
                       digests.alias("digests"), digest(F.array_join(digests, "")).alias("digest"))


def climb(nodes: DataFrame, largest: int, arity: int = ARITY) -> tuple[list[DataFrame], DataFrame]:
    """The runs of every level, lowest first, and the roots (tree, digest) of trees of at most ``largest`` nodes."""
    levels, roots = [], nodes.where("n = 1").select("tree", "digest")
    while largest > 1:
        nodes = pinned(_parents(nodes.where("n > 1"), arity))
        levels.append(nodes)
        roots = roots.unionByName(nodes.where("n = 1").select("tree", "digest"))
        largest = -(-largest // arity)
    return levels, roots


def _below(nodes: DataFrame, runs: DataFrame | None, above: DataFrame, arity: int) -> DataFrame:
    """``nodes`` (tree, i, n, ...) with their ``path``: from their run's, or from ``above`` where a node is the root."""
    alone = nodes.where("n = 1").join(above, "tree")
    if runs is None:
        return alone
    slot = F.pmod("i", F.lit(arity)).cast("int")
    beside = F.struct(F.array_join(F.slice("_digests", F.lit(1), slot), "").alias("left"),
                      F.array_join(F.slice("_digests", slot + 2, F.lit(arity)), "").alias("right"))
    carried = [c for c in above.columns if c not in ("tree", "path")]
    own = runs.select("tree", F.col("i").alias("_run"), F.col("digests").alias("_digests"), F.col("path").alias("_path"), *carried)
    inner = (nodes.where("n > 1").withColumn("_run", _div(F.col("i"), arity)).join(own, ["tree", "_run"])
             .withColumn("path", F.concat(F.array(beside), F.col("_path"))))
    return alone.unionByName(inner.select(alone.columns))


def descend(nodes: DataFrame, levels: list[DataFrame], above: DataFrame, arity: int = ARITY) -> DataFrame:
    """``nodes`` with the ``path`` to the root of all; ``above`` has that of each tree's root, and columns to carry."""
    runs = None
    for level in reversed(levels):
        runs = _below(level.select("tree", "i", "n", "digests"), runs, above, arity)
    return _below(nodes, runs, above, arity)


def folded(start: Column, path: Column) -> Column:
    """The root that follows from a node's digest and its path."""
    return F.aggregate(path, start, lambda d, step: digest(F.concat(step["left"], d, step["right"])))


def path_digest(path: Column) -> Column:
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


@dataclass(frozen=True)
class Manifest:
    """``leaves``: tree, i, n, digest, then the caller's columns; ``levels`` and ``top_levels``: the runs of every level;
    ``trees``: tree, subroot, path of the subroot; ``root``: of the dataset, null if it is empty."""
    leaves: DataFrame
    levels: list[DataFrame]
    top_levels: list[DataFrame]
    trees: DataFrame
    root: str | None
    arity: int

    def proofs(self) -> DataFrame:
        """Every leaf with its subroot and its path."""
        return descend(self.leaves, self.levels, self.trees, self.arity)


def _indexed(rows: DataFrame, order: list) -> tuple[DataFrame, int]:
    sliced, table = numbered_within(rows, "tree", order)
    largest = table.agg(F.max("_n")).first()[0] or 0
    return sliced.join(table, ["tree", "_slice"]).withColumns(
        {"i": F.col("_at") + F.col("_shift"), "n": F.col("_n")}).drop("_slice", "_at", "_shift", "_n"), largest


def build(leaves: DataFrame, order: list[str], arity: int = ARITY) -> Manifest:
    """The manifest of ``leaves`` (tree, digest, more), ordered by ``order``, then digest, within each tree."""
    nodes, largest = _indexed(leaves, [F.col(c).asc_nulls_first() for c in [*order, "digest"]])
    levels, roots = climb(nodes, largest, arity)
    subroots = pinned(roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"))
    top, count = _indexed(subroots, [F.col("name").asc()])
    top_levels, root = climb(top, count, arity)
    first = root.first()
    end = root.select("tree", F.array().cast(PATH).alias("path"))
    trees = pinned(descend(top, top_levels, end, arity).select(
        F.col("name").alias("tree"), "path", F.col("digest").alias("subroot")))
    return Manifest(nodes, levels, top_levels, trees, first and first["digest"], arity)


def document_leaves(docs: DataFrame) -> DataFrame:
    """Leaves of documents: tree, doc_id, digest, and the digest after tampering (null where none takes place)."""
    lowered = F.translate(F.col("text"), UPPER, UPPER.lower())
    values = [F.col(c) for c in FIELDS]
    return docs.select(group_key(F.col("lang")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
                       leaf_digest(values).alias("digest"),
                       F.when(fold(F.col("doc_id"), 3) == 0, leaf_digest([*values[:-1], lowered])).alias("altered"))


def verify(docs: DataFrame, arity: int = ARITY) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and whether its (perhaps tampered) row still leads to the root."""
    manifest = build(document_leaves(docs), ["doc_id"], arity)
    root = F.lit(manifest.root).cast("string")
    return manifest.proofs().select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", root.alias("root"),
        path_digest(F.col("path")).alias("proof_sha256"),
        folded(F.coalesce("altered", "digest"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
