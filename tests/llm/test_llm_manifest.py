"""Operator 11 against plain Python: odd rows, several arities, tampering, repeated rows, no rows."""

import collections
import hashlib
import random
import zlib

import pytest
from pyspark.sql import types as T

from headway.llm import manifest

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operator's own columns have, too
    T.StructField("tree", T.StringType()), T.StructField("digest", T.StringType()), T.StructField("i", T.StringType()),
    T.StructField("path", T.StringType()), T.StructField("_slice", T.StringType()), T.StructField("verified", T.StringType())])


def odd_rows():
    rng = random.Random(11)
    texts = [None, "", " ", "\n", "ÉCOLE école", "lower only", "漢字 A", "A" * 40_000, "tab\tB", "🙂X"]
    rows = [(i, rng.choice(texts) if i % 3 else f"Text {i}", ["en", "de", None, "", "é", "1"][min(i % 11, 5)],
             None if i % 7 == 0 else f"src{i % 4}", None if i % 5 == 0 else i) for i in range(700)]
    rows += [(900, "Alone", "zz", "s", 5), (None, "No id", "en", None, None), (None, None, None, None, None)]
    rows += [rows[4]] * 30 + [(4, "other text, same id", "é", "s", 1)]
    rng.shuffle(rows)
    return [(*r, "t", "d", "i", "p", "s", "v") for r in rows]


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, lowered=False):
    i, text, lang, source, n = row[:5]
    if lowered and text is not None:
        text = text.translate({c: c + 32 for c in range(65, 91)})
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))


def levels_of(nodes, arity):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H("".join(out[-1][k:k + arity])) for k in range(0, len(out[-1]), arity)])
    return out


def path_of(levels, i, arity):
    out = []
    for level in levels[:-1]:
        first = i - i % arity
        out.append(("".join(level[first:i]), "".join(level[i + 1:first + arity])))
        i //= arity
    return out


def brute(rows, arity=8):
    trees = collections.defaultdict(list)
    for r in rows:
        trees[r[2]].append(r)
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    leaves = {t: sorted(trees[t], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for t in order}
    levels = {t: levels_of([leaf(r) for r in leaves[t]], arity) for t in order}
    top = levels_of([levels[t][-1][0] for t in order], arity)
    out = collections.Counter()
    for k, t in enumerate(order):
        for i, r in enumerate(leaves[t]):
            path = path_of(levels[t], i, arity) + path_of(top, k, arity)
            tampered = zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 3 == 0
            now = leaf(r, tampered)
            for left, right in path:
                now = H(left + now + right)
            out[r[0], leaf(r), levels[t][-1][0], top[-1][0], H("".join(a + b for a, b in path)), now, now == top[-1][0]] += 1
    return out


@pytest.mark.parametrize("arity", [8, 2, 3])
def test_manifest_equals_plain_python(spark, arity):
    rows = odd_rows()
    got = manifest.verify(spark.createDataFrame(rows, SCHEMA).repartition(3), arity)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = brute(rows, arity)
    assert collections.Counter(map(tuple, got.collect())) == want
    assert {k[-1] for k in want} == {True, False}


def test_one_row_and_one_tree(spark):
    one = [(7, "X", "en", "s", 1, *"tdipsv")]
    (row,) = manifest.verify(spark.createDataFrame(one, SCHEMA)).collect()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == H("")
    many = [(i, f"t{i}", "en", "s", 1, *"tdipsv") for i in range(9)]      # a run of one at the end
    assert collections.Counter(map(tuple, manifest.verify(spark.createDataFrame(many, SCHEMA)).collect())) == brute(many)


def test_empty_table(spark):
    assert manifest.verify(spark.createDataFrame([], SCHEMA)).collect() == []


def test_levels_shrink_by_the_arity(spark):
    rows = [(i, "t", "en", "s", 1, *"tdipsv") for i in range(600)]
    made = manifest.build(manifest.document_leaves(spark.createDataFrame(rows, SCHEMA)), ["doc_id"])
    assert [level.count() for level in made.levels] == [75, 10, 2, 1] and made.root
