"""The dealt operators as queries: production parameters, whole tables, the contract's columns."""

from __future__ import annotations

from headway.llm import (byte_bpe, jaccard_join, lm_scoring, manifest, mixing, nearest, oracle, packing, quality,
                         secrets, sharding, token_counts, toxicity, vector_codes)
from headway.llm.common import read_table


def op1_byte_bpe(spark, sf_dir):
    return byte_bpe.round_trip(read_table(spark, sf_dir, "documents"))


def op2_deleted_interpolation(spark, sf_dir):
    return lm_scoring.score(read_table(spark, sf_dir, "documents"))


def op3_feistel_shards(spark, sf_dir):
    return sharding.shard(read_table(spark, sf_dir, "documents"))


def op4_secret_ownership(spark, sf_dir):
    return secrets.scan(read_table(spark, sf_dir, "documents"))


def op5_quality_cascade(spark, sf_dir):
    return quality.measure(read_table(spark, sf_dir, "documents"))


def op6_ngram_jaccard(spark, sf_dir):
    return jaccard_join.join(read_table(spark, sf_dir, "documents"))


def op7_token_counts(spark, sf_dir):
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"))


def op8_toxicity_field(spark, sf_dir):
    return toxicity.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_hilbert_neighbours(spark, sf_dir):
    return nearest.search(read_table(spark, sf_dir, "embeddings"))


def op10_best_two_fit(spark, sf_dir):
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark, sf_dir):
    return manifest.verify(read_table(spark, sf_dir, "documents"))


def op12_anchor_codes(spark, sf_dir):
    return vector_codes.compress(read_table(spark, sf_dir, "embeddings"))


def op13_pivotal_mixing(spark, sf_dir):
    return mixing.mix(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_deleted_interpolation": op2_deleted_interpolation,
    "op3_feistel_shards": op3_feistel_shards,
    "op4_secret_ownership": op4_secret_ownership,
    "op5_quality_cascade": op5_quality_cascade,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_token_counts": op7_token_counts,
    "op8_toxicity_field": op8_toxicity_field,
    "op9_hilbert_neighbours": op9_hilbert_neighbours,
    "op10_best_two_fit": op10_best_two_fit,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_anchor_codes": op12_anchor_codes,
    "op13_pivotal_mixing": op13_pivotal_mixing,
}

#: Where SQL cannot express an operator (tokenizers, trained models, keyed hashes), tests hold it against brute force.
ORACLE: dict[str, str] = {"op4_secret_ownership": oracle.OP4, "op5_quality_cascade": oracle.OP5,
                          "op11_merkle_manifest": oracle.OP11, "op12_anchor_codes": oracle.OP12,
                          "op13_pivotal_mixing": oracle.OP13}
