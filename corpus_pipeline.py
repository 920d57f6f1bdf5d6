"""Corpus pipeline: quality rules, toxicity, near-duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes what a
stage keeps as Parquet in the shared folder and reads it again for the next.
All stages but the last return the columns of their input.

A null or empty text fails the quality rules and goes; very long texts are judged,
compared, scanned and packed whole.  Rows without an id pass the near-duplicate
stage as they are.  Of rows that repeat an id and its text one stays there; repeated
texts under other ids go but for the smallest id, which also settles ties.  Extra
columns, whatever their names, stay until the last stage, which returns pieces.
An empty table passes every stage as an empty one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from headway.llm import jaccard_join, packing, quality, secrets, toxicity
from headway.llm.common import read_table
from headway.session import ensure_checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality.keep(docs)


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score a half or more go."""
    return toxicity.keep_clean(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the smallest id stays."""
    return jaccard_join.keep_one(docs)


def secret_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking credentials are replaced by a mark."""
    return secrets.redact(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxic_documents),
    ("ngram_jaccard", near_duplicates),
    ("secret_scan", secret_spans),
    ("best_fit_packing", packed_sequences),
]

#: The stages train a classifier and encode with a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, every stage written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    base = spark.sparkContext.getCheckpointDir() or ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir() or base}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
