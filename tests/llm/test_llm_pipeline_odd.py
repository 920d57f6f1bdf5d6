"""The pipeline's stages, one after the other, on odd rows: nulls, repeats, long texts, clashing names, no rows."""

import os
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def _docs(spark):
    rng = random.Random(2)
    words = "the river and a bridge were built of stone near old mill where people of this town met every week for bread".split()

    def prose(n):
        return " ".join(rng.choice(words) + str(rng.randrange(300)) for _ in range(n))

    base = [prose(n) for n in (80, 120, 400, 9000)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(20, base[0]), (1, base[1]), (1, base[1]), (None, base[2]), (None, None), (21, None), (22, ""), (23, "few words"),
             (3, base[2]), (24, prose(100) + " token=ABCdef0123456789 end")]
    df = spark.createDataFrame([(i, t, "en", "src", None if t is None else len(t)) for i, t in rows],
                               "doc_id long, text string, lang string, source string, n_chars int")
    for name in ("_kept", "_row", "_doc", "component_id", "score", "kept", "size", "part"):
        df = df.withColumn(name, F.lit("x"))
    return df


def test_stages_on_odd_rows(spark):
    docs, kept = _docs(spark), {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SF)
        if name != "best_fit_packing":
            assert docs.dtypes == before.dtypes
        docs = docs.checkpoint()
        kept[name] = sorted((r.doc_id is not None, r.doc_id or 0) for r in docs.select("doc_id").distinct().collect())
    every = [0, 1, 2, 3, 24]
    assert kept["quality_rules"] == [(False, 0)] + [(True, i) for i in sorted([*every, 20])]       # null and short texts go
    assert kept["ngram_jaccard"] == [(False, 0)] + [(True, i) for i in every]                       # 20 copies 0
    pieces = docs.collect()
    assert sum(r.length for r in pieces if r.doc_id == 3) > 4096                                    # packed whole
    assert {r.sequence_id for r in pieces} and all(r.offset + r.length <= 4096 for r in pieces)


def test_stages_on_no_rows(spark):
    docs = _docs(spark).where("doc_id = -1")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
