"""Operator 12 against plain Python: odd vectors, ties, repeats, huge numbers, few rows, no rows; trees against scans."""

import collections
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from headway.llm import vector_codes as vc

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
    # names that the operator's own columns have, too
    T.StructField("vector", T.StringType()), T.StructField("code", T.StringType()), T.StructField("block", T.StringType()),
    T.StructField("error", T.StringType()), T.StructField("_salt", T.StringType())])


def odd_rows(n=400, dims=32, seed=1):
    rng = random.Random(seed)

    def vector(scale=0.2):
        return [float(np.float32(rng.gauss(0, scale))) for _ in range(dims)]

    same = vector()
    rows = [(i, same if rng.random() < 0.3 else vector(), rng.choice([0, 0, 0, 1, 2, None])) for i in range(n)]
    rows += [(n + 1, None, 1), (n + 2, [None] + vector()[1:], 1), (n + 3, [math.nan] + vector()[1:], 2), (-9, [math.inf] + vector()[1:], 2),
             (n + 4, [0.0] * dims, None), (n + 5, vector(30.0), 3), (None, vector(), 1), rows[5], rows[5], (7, vector(), 0),
             (n + 6, [], 1), (n + 7, [0.5], None), (n + 8, vector() * 2, 9)]
    rng.shuffle(rows)
    return [(*r, "v", "c", "b", "e", "s") for r in rows]


def floor_int(x):
    return math.floor(x) * 256 + math.floor((x - math.floor(x)) * 256)


def brute(rows, dims, parts=16, entries=64, rounds=2):
    kept, odd = [], []
    for i, v, label, *_ in rows:
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        (kept if len(v) == dims else odd).append((i, [floor_int(x) for x in v], label))
    width = dims // parts
    cut = [[x[k * width:(k + 1) * width] for k in range(parts)] for _, x, _ in kept]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[x[k * width:(k + 1) * width] for _, x, _ in first] for k in range(parts)]

    def near(k, p):
        return min((sum((a - b) ** 2 for a, b in zip(p, e)), at) for at, e in enumerate(books[k]))

    for _ in range(rounds):
        new = []
        for k in range(parts):
            groups = collections.defaultdict(list)
            for c in cut:
                groups[near(k, c[k])[1]].append(c[k])
            new.append([[sum(x) // len(groups[e]) for x in zip(*groups[e])] if e in groups else entry for e, entry in enumerate(books[k])])
        books = new
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    found = [[near(k, c[k]) for k in range(parts)] for c in cut]
    by_label = collections.Counter()
    for (_, _, label), f in zip(kept, found):
        by_label[label] += sum(d for d, _ in f)

    def long(x):
        return min(x, vc.LONG)

    out = collections.Counter((i, "".join(f"{e:02x}" for _, e in f), long(sum(d for d, _ in f)), long(by_label[label]), digest)
                              for (i, _, label), f in zip(kept, found))
    with_codes = {label for _, _, label in kept}
    out.update((i, None, None, long(by_label[label]) if label in with_codes else None, digest) for i, _, label in odd)
    return out


def got(df):
    assert df.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return collections.Counter(map(tuple, df.collect()))


def test_codes_equal_plain_python(spark, monkeypatch):
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows, 32)
    assert got(vc.compress(df.repartition(3))) == want
    assert got(vc.compress(df.repartition(1))) == want


def test_small_blocks_and_more_rounds(spark):
    rows = odd_rows(150, seed=4)
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    same = vc.usable(df).where("size(vector) = 32")
    blocks = vc.blocks_of(same, block=7).cache()
    assert blocks.count() > 20
    books = vc.train(blocks, vc.first_codebooks(same), 3)
    assert {vc.codebook_digest(books)} == {k[-1] for k in brute(rows, 32, rounds=3)}


def test_fewer_vectors_than_entries(spark):
    rows = odd_rows(12, 16, seed=2)
    assert got(vc.compress(spark.createDataFrame(rows, SCHEMA))) == brute(rows, 16)


def test_huge_components(spark):
    rows = odd_rows(60, 16, seed=6) + [(1000, [2.0 ** 127] + [1.0] * 15, 0, *"vcbes"), (1001, [-2.0 ** 99] * 16, 1, *"vcbes"), (-5, [1e9] * 16, 2, *"vcbes")]
    assert got(vc.compress(spark.createDataFrame(rows, SCHEMA))) == brute(rows, 16)


def test_nothing_to_code(spark):
    assert vc.compress(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, None, 0, *"vcbes"), (2, [1.0] * 5, 0, *"vcbes"), (3, [], None, *"vcbes")]
    assert got(vc.compress(spark.createDataFrame(rows, SCHEMA))) == collections.Counter(
        [(2, None, None, None, None), (3, None, None, None, None)])


@pytest.mark.parametrize("spread", [2, 40, 4000])
def test_trees_equal_scans_and_save_work(spread):
    rng = np.random.default_rng(spread)
    centres = rng.integers(-spread * 50, spread * 50, (40, 4))
    x = centres[rng.integers(0, 40, 3000)] + rng.integers(-spread, spread + 1, (3000, 4))
    x[500:1200] = x[3]
    entries = np.concatenate([x[rng.integers(0, 3000, 50)], x[3:4], x[3:4]])
    tree = vc.metric_tree(x)
    codes = vc.nearest_entries(x, entries)
    assert (vc.assigned(x, tree, entries) == codes).all()
    sums, counts = vc.summed(x, tree, entries)
    want = np.zeros_like(sums)
    np.add.at(want, codes, x)
    assert (sums == want).all() and (counts == np.bincount(codes, minlength=len(entries))).all()
    owned, small = vc.owners(tree, entries)
    whole = sum(int(tree.count[n]) for n, _ in owned)
    assert whole + sum(int(tree.count[n]) for n, _ in small) == 3000
    assert whole > 1500          # clustered points: most fall to an entry with their ball


def test_balls_hold_their_points():
    x = np.random.default_rng(3).integers(-99, 99, (700, 5))
    tree = vc.metric_tree(x)
    assert sorted(tree.order.tolist()) == list(range(700))
    for k in range(len(tree.left)):
        own = x[tree.order[tree.start[k]:tree.start[k] + tree.count[k]]]
        assert (own.sum(0) == tree.sum[k]).all()
        assert np.sqrt(((own - tree.centre[k]) ** 2).sum(1)).max() <= tree.radius[k] + 1e-9
