"""The registered queries and the pipeline on the smallest tables."""

import collections
import json
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from headway.llm import queries  # noqa: E402
from headway.llm.common import read_table  # noqa: E402
from oracle_check import compare  # noqa: E402
from tests_llm_helpers import brute_pipeline  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")

COLUMNS = {
    "op1_byte_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op2_deleted_interpolation": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op3_feistel_shards": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op4_secret_ownership": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op5_quality_cascade": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op6_ngram_jaccard": ["doc_id", "n_shingles", "component_id"],
    "op7_token_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op8_toxicity_field": ["doc_id", "held_out", "score", "predicted"],
    "op9_hilbert_neighbours": ["query_id", "rank", "vec_id", "score"],
    "op11_merkle_manifest": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
    "op12_anchor_codes": ["vec_id", "code", "error", "label_error", "codebooks_sha256"],
    "op13_pivotal_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    "op10_best_two_fit": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
}


def test_all_are_registered():
    assert set(COLUMNS) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_returns_the_contract(spark, name):
    df = queries.QUERIES[name](spark, SF)
    assert df.columns[:len(COLUMNS[name])] == COLUMNS[name]
    docs = read_table(spark, SF, "documents").count()
    assert df.count() >= (docs if "vec_id" not in COLUMNS[name] else 20)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_its_twin(spark, name):
    assert compare(spark, SF, [name])[name]["ok"]


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "toxicity", "ngram_jaccard", "secret_scan", "best_fit_packing"]


def test_pipeline_against_plain_python(spark):
    got = corpus_pipeline.run(spark, SF).collect()
    want = brute_pipeline(spark, SF)
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want


def test_stages_keep_the_columns(spark):
    docs = read_table(spark, SF, "documents").limit(60)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).dtypes == docs.dtypes
