"""Operator 7, token counts: a map-side two-tier lookup.

Tier one is a broadcast table of the lengths (numbers of tokens) of the most
frequent pre-tokens of the whole corpus, at most ``top`` of them.  They are
found by a Misra-Gries summary per task, which reads every pre-token and keeps
at most ``SUMMARY_ROWS`` counters, and a partially aggregated sum over the
summaries.  Tier two is a cache in each worker which encodes misses with the
library.  No pre-token of a document is shuffled; only the summaries are.

Null and empty texts have 0 bytes and 0 tokens.  Texts of any length are counted
whole.  Which pre-tokens of equal frequency are in the table changes no count.
Repeated rows give repeated rows.  An empty table gives an empty result.  Columns other than doc_id and
text are ignored.
"""

from __future__ import annotations

from collections import Counter

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import id_and_text, pinned, share_vocabulary
from headway.llm.wordpiece import TokenCache

SUMMARY_ROWS = 50_000    # counters that a task keeps
TOP = 65_536             # rows of the broadcast table (a few MB at most)
MAX_PIECE = 64           # bytes of a pre-token in the table; longer ones go to tier two
LIMIT = 2048


def frequent_pieces(docs: DataFrame, cache: TokenCache, top: int = TOP) -> list[bytes]:
    """The most frequent white-space separated pre-tokens of all texts, at most ``top``."""
    small = cache.small

    def summary(batches):
        """Misra-Gries: at most SUMMARY_ROWS counters leave the task, whatever the number of pre-tokens."""
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update((text.encode().lower() if small else text.encode()).split())
                if len(counts) > 4 * SUMMARY_ROWS:
                    least = sorted(counts.values(), reverse=True)[SUMMARY_ROWS]
                    counts = Counter({k: n - least for k, n in counts.items() if n > least})
        best = [(k, n) for k, n in counts.most_common(SUMMARY_ROWS) if len(k) <= MAX_PIECE]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in best], pa.binary()),
                                          pa.array([n for _, n in best], pa.int64())], ["piece", "n"])

    sums = pinned(id_and_text(docs).select("text").mapInArrow(summary, "piece binary, n long")
                  .groupBy("piece").agg(F.sum("n").alias("n")))
    total = sums.agg(F.sum("n").alias("n")).first().n or 0
    # at most 8 * top pieces can hold a (8 * top)-th of the total each, whatever the corpus
    found = sums.where(F.col("n") * (8 * top) >= total).orderBy(F.desc("n"), "piece").limit(top)
    return [bytes(r.piece) for r in found.select("piece").collect()]


def count_tokens(docs: DataFrame, path: str | None = None, top: int = TOP, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text."""
    spark = docs.sparkSession
    path = path or public_tokenizers.path("word_bpe_49k.json")
    shared = share_vocabulary(spark, path)
    own = TokenCache(shared.value["file"], len)
    lengths = {p: own[p] for p in frequent_pieces(docs, own, top)}
    table = spark.sparkContext.broadcast(lengths)

    def count(batches):
        own = shared.value
        if "lengths" not in own:
            own["lengths"] = TokenCache(own["file"], len, table.value)
        cache = own["lengths"]
        length = cache.__getitem__
        for batch in batches:
            ids, sizes, tokens = batch.column(0), [], []
            for text in batch.column(1).to_pylist():
                sizes.append(len(text.encode()))
                tokens.append(sum(map(length, cache.split(text))))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array([n > limit for n in tokens], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return id_and_text(docs).mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
