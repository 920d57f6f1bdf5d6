"""Operator 6 on large groups around the limit: tiles, sketches, exact stage; and what keep_one keeps."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from headway.llm import jaccard_join as jj
from test_llm_operators import brute_components


def around_the_limit(n=260, seed=7):
    """Documents of one origin: pairs share from half to nearly all of their shingles."""
    rng = random.Random(seed)
    origin = [f"o{k}" for k in range(120)]
    rows = []
    for i in range(n):
        words = list(origin)
        k = rng.choice((1, 4, 8, 14, 25))
        at = rng.randrange(0, 120 - k)
        words[at:at + k] = [f"x{rng.randrange(10 ** 6)}" for _ in range(k)]
        if rng.random() < 0.3:
            words = words[:rng.randrange(100, 121)]
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(f"y{rng.randrange(50)}" for _ in range(60))) for i in range(40)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("tile, bits, partners", [(1024, 8, 6), (16, 8, 6), (64, 1, 1000), (16, 2, 1)])
def test_groups_around_the_limit(spark, monkeypatch, tile, bits, partners):
    monkeypatch.setattr(jj, "TILE", tile)
    monkeypatch.setattr(jj, "SKETCH_BITS", bits)
    monkeypatch.setattr(jj, "PARTNER_RUNS", partners)
    monkeypatch.setattr(jj, "TURN", 2)
    rows = around_the_limit()
    want, _ = brute_components(rows)
    assert 10 < len(set(want.values())) < 280
    got = jj.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_rows_grow_with_members_not_with_pairs(spark):
    """Documents that all meet and that nothing links: no stage emits their pairs."""
    rng = random.Random(3)
    rows = [(i, " ".join([f"o{k}" for k in range(70)] + [f"x{rng.randrange(10 ** 6)}" for _ in range(30)])) for i in range(400)]
    parts = spark.createDataFrame([], "doc_id long, component_id long")
    hashes = jj.WordHashes()
    sets = {i: jj.shingles(t, hashes) for i, t in rows}
    run = [(2, 1, 400, np.arange(400, dtype=np.int64).tobytes(), np.array([len(sets[i]) for i in range(400)], np.uint32).tobytes(),
            bytes([jj.PROBE | jj.INDEX]) * 400)]
    runs = spark.createDataFrame([tuple(bytearray(x) if isinstance(x, bytes) else x for x in r) for r in run], jj.FOUND)
    sketches = spark.createDataFrame([(i, len(sets[i]), bytearray(jj.sketch(sets[i]))) for i in sets], "doc_id long, size int, sketch binary")
    tiles = jj._open_tiles(runs, parts)
    assert tiles.count() == 400
    assert jj._likely_links(tiles, sketches, 80).count() < 40
    assert jj._undecided(tiles, sketches, 80).count() < 40


def test_sketches_bound_every_intersection():
    rng = np.random.default_rng(5)
    for n in (3, 40, 600):
        base = rng.integers(0, 2 ** 64, n, np.uint64)
        sets = []
        for _ in range(30):
            keep = base[rng.random(n) < rng.uniform(0.6, 1)]
            sets.append(np.unique(np.concatenate([keep, rng.integers(0, 2 ** 64, max(1, n - len(keep)), np.uint64)])))
        t = pa.table({"doc_id": range(30), "size": [len(s) for s in sets], "flag": [3] * 30, "part": range(30), "block": [0] * 30,
                      "lo": [0] * 30, "hi": [0] * 30})
        tile = jj._Tile(t, 80)
        bound = jj._Sketches(tile, [b"" if k == 4 else jj.sketch(s) for k, s in enumerate(sets)])
        for i in range(30):
            j = tile.met(i)
            found = set(bound(i, j).tolist())
            for k in j.tolist():
                if jj._similar(sets[tile.order[i]], sets[tile.order[k]], 80):
                    assert k in found


TEXTS = {"a": "one two three four five six seven eight nine ten", "b": "red green blue white black grey brown pink gold teal"}


def test_keep_one_with_repeated_ids_and_clashing_names(spark):
    rows = [(1, TEXTS["a"], "x"), (1, TEXTS["b"], "y"), (1, TEXTS["a"], "x"), (2, TEXTS["a"], "z"), (3, None, "n"), (3, None, "n"),
            (None, TEXTS["a"], "q"), (None, TEXTS["a"], "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _kept string").withColumn("component_id", F.lit("c")).withColumn(
        "_Text_Hash", F.lit(1))
    for n in (1, 5):
        kept = jj.keep_one(docs.repartition(n))
        assert kept.dtypes == docs.dtypes
        assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted(
            [(1, TEXTS["a"]), (1, TEXTS["b"]), (3, ""), (0, TEXTS["a"]), (0, TEXTS["a"])])


def test_a_text_that_nothing_is_linked_with_stays_whatever_its_id(spark):
    other = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [(2, TEXTS["a"]), (3, TEXTS["a"]), (3, TEXTS["b"]), (4, other), (4, TEXTS["b"]), (2 ** 62, "x"), (-7, other)]
    kept = jj.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    ids = sorted((r.doc_id, r.text) for r in kept)
    assert {t for _, t in ids} == {TEXTS["a"], TEXTS["b"], other, "x"} and len(ids) == 4
    assert (2, TEXTS["a"]) in ids and (-7, other) in ids and ids.count((3, TEXTS["a"])) == 0


def test_repeated_ids_with_other_texts_link_by_each(spark):
    rows = [(5, TEXTS["a"]), (5, TEXTS["b"]), (7, TEXTS["a"]), (8, TEXTS["b"])]
    got = {(r.doc_id, r.component_id) for r in jj.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(5, 5), (7, 5), (8, 5)}
