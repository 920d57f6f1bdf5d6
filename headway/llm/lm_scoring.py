"""Operator 2, language-model scoring by deleted interpolation.

p(w | u) = l2(b) c(u,w)/c(u) + l1(b) c(w)/N + l0(b) / (V+1), where b is the bucket
of the context's frequency c(u).  The weights l(b) are learned by expectation
maximisation on held-out counts: counts of the training folds but one are held
against the words of that one.  Counts for scoring are those of all training
folds.

Every word and word pair of the corpus is counted.  Documents are dealt into
chunks of bounded size by a hash.  A chunk sends its distinct keys (64-bit hashes
of words and pairs) with its own training counts, packed by key range; the task
of a range adds them up and answers each chunk, key by key.  A word in every
document is one key a chunk, so no key is hot.  For the weights, held-out words
are gathered into cells of (bucket, binned c(u,w)/c(u), binned c(w)/N), at most
``BUCKETS * BINS * BINS`` of them however large the corpus, and the driver
iterates on these.

A null or empty text is one end token; texts of any length train and score whole.
Repeated rows, and texts that tie in all counts, train and score as often as they
occur.  A null id is in fold 0.  Without training documents the score is that of
V = N = 0: each token has probability 1.  An empty table gives an empty result.  Columns other than doc_id and
text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import fold, id_and_text, pinned, shuffle_partitions

FOLDS, HELD_OUT, WEIGHTS_FOLD = 10, 0, 1
CHUNK_BYTES = 12_000_000
RANGE_BYTES = 16_000_000
BUCKETS, BINS = 16, 32          # of context frequency by powers of four; of relative frequencies by half powers of ten
ROUNDS = 40
CACHE_ROWS = 400_000
END, START = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)
MUL = [np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0xC2B2AE3D27D4EB4F)]
WORD, PAIR = 0, 1


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_ROWS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


class Chunk:
    """Tokens of a chunk's documents, and its distinct word and pair keys in order."""

    def __init__(self, texts: list[str], folds: np.ndarray):
        of = WordHashes().__getitem__
        words = [t.encode().lower().split() for t in texts]         # of bytes: A-Z alone; space and U+0009 to U+000D
        self.length = np.array([len(w) + 1 for w in words], np.int64)
        self.first = np.cumsum(self.length) - self.length
        token = np.empty(int(self.length.sum()), np.uint64)
        for at, own in zip(self.first.tolist(), words):
            token[at:at + len(own)] = np.fromiter(map(of, own), np.uint64, len(own))
            token[at + len(own)] = END
        self.fold = np.repeat(folds, self.length)
        context = np.concatenate([token[:1], token[:-1]])
        context[self.first] = START
        pair = context * MUL[0] + token
        pair = (pair ^ (pair >> np.uint64(31))) * MUL[1]
        pair ^= pair >> np.uint64(29)
        self.keys, self.at = {}, {}
        self.keys[WORD], self.at[WORD] = np.unique(token, return_inverse=True)
        self.keys[PAIR], self.at[PAIR] = np.unique(pair, return_inverse=True)
        # a word is the context as often as it occurs, the start as often as the end
        before = np.concatenate([self.at[WORD][:1], self.at[WORD][:-1]])
        before[self.first] = np.searchsorted(self.keys[WORD], END)
        self.context = before

    def own_counts(self, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """Per key, occurrences in the training folds but the one for the weights, and in that one."""
        n = len(self.keys[kind])
        rest = (self.fold != HELD_OUT) & (self.fold != WEIGHTS_FOLD)
        return (np.bincount(self.at[kind][rest], minlength=n).astype(np.uint32),
                np.bincount(self.at[kind][self.fold == WEIGHTS_FOLD], minlength=n).astype(np.uint32))


def _texts(table: pa.Table) -> Chunk:
    return Chunk(table.column("text").to_pylist(), table.column("fold").to_numpy().astype(np.int64))


ASKED = "range int, chunk long, kind int, keys binary, rest binary, own binary"
ANSWER = "chunk long, range int, kind int, rest binary, own binary, types long, tokens long, rest_types long, rest_tokens long"


def _asked(ranges: int):
    """A chunk's keys and counts by key range."""
    def run(table: pa.Table) -> pa.Table:
        chunk, name = _texts(table), table.column("chunk")[0].as_py()
        rows = []
        for kind in (WORD, PAIR):
            keys, (rest, own) = chunk.keys[kind], chunk.own_counts(kind)
            cuts = np.searchsorted(((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32), np.arange(ranges + 1))
            for r in range(ranges):
                x = slice(cuts[r], cuts[r + 1])
                if cuts[r] < cuts[r + 1]:
                    rows.append((r, name, kind, _packed(keys[x]), _small(rest[x]), _small(own[x])))
        return _table(rows, ASKED)
    return run


def _answered(batches):
    """Sums over all chunks of a key range, for each chunk in the order of its keys."""
    asked: dict[tuple[int, int], list] = {}
    for batch in batches:
        for r, chunk, kind, *blobs in zip(*(batch.column(c).to_pylist() for c in range(6))):
            asked.setdefault((r, kind), []).append((chunk, *blobs))
    for (r, kind), rows in asked.items():
        keys = [_unpacked(x[1]) for x in rows]
        found, at = np.unique(np.concatenate(keys), return_inverse=True)
        rest, own = (np.bincount(at, np.concatenate([_large(x[c]) for x in rows]), len(found)).astype(np.uint64) for c in (2, 3))
        every = rest + own
        stats = (int((every > 0).sum()), int(every.sum()), int((rest > 0).sum()), int(rest.sum()))
        done = 0
        for k, (row, key) in enumerate(zip(rows, keys)):
            x = at[done:done + len(key)]
            done += len(key)
            yield _table([(row[0], r, kind, _small(rest[x]), _small(own[x]), *(stats if not k else (0, 0, 0, 0)))],
                         ANSWER).to_batches()[0]


def _packed(keys: np.ndarray) -> bytes:
    """Sorted keys by their differences, byte plane by byte plane: the high planes are nearly all zero."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return zstandard.compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _small(counts: np.ndarray) -> bytes:
    return zstandard.compress(counts.astype(np.uint64).tobytes(), 1)


def _large(blob: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(blob), np.uint64)


ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_()}


def _table(rows: list[tuple], schema: str) -> pa.Table:
    fields = [f.split(" ") for f in schema.split(", ")]
    cols = list(zip(*rows)) or [()] * len(fields)
    return pa.table([pa.array(c, ARROW[t]) for c, (_, t) in zip(cols, fields)], names=[n for n, _ in fields])


def _counts(answers: pa.Table, kind: int, which: str) -> np.ndarray:
    """A chunk's answers of a kind, in the order of its keys."""
    rows = sorted((r, x) for r, k, x in zip(answers.column("range").to_pylist(), answers.column("kind").to_pylist(),
                                           answers.column(which).to_pylist()) if k == kind)
    return np.concatenate([_large(x) for _, x in rows]).astype(np.float64)


def bucket(context: np.ndarray) -> np.ndarray:
    """Bucket of a context's frequency: 0 for unseen ones, then powers of four."""
    return np.where(context > 0, np.minimum(1 + np.log2(np.maximum(context, 1)) // 2, BUCKETS - 1), 0).astype(np.int64)


def _bin(f: np.ndarray) -> np.ndarray:
    return np.where(f > 0, np.clip(BINS - 1 + np.ceil(2 * np.log10(np.maximum(f, 1e-300))), 1, BINS - 1), 0).astype(np.int64)


CELLS = "cell long, n double, pair double, word double"


def _cells(tokens: int):
    """Held-out words of a chunk by bucket and binned relative frequencies."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = _texts(left)
        on = np.flatnonzero(chunk.fold == WEIGHTS_FOLD)
        if not len(on):
            return _table([], CELLS)
        word, pair = _counts(right, WORD, "rest"), _counts(right, PAIR, "rest")
        context = word[chunk.context[on]]
        f2 = pair[chunk.at[PAIR][on]] / np.maximum(context, 1)
        f1 = word[chunk.at[WORD][on]] / max(tokens, 1)
        cell = (bucket(context) * BINS + _bin(f2)) * BINS + _bin(f1)
        found, at = np.unique(cell, return_inverse=True)
        return pa.table({"cell": found, "n": np.bincount(at).astype(np.float64), "pair": np.bincount(at, f2),
                         "word": np.bincount(at, f1)})
    return run


def learn_weights(cells: np.ndarray, types: int) -> np.ndarray:
    """Expectation maximisation: (BUCKETS, 3) weights of pair, word and uniform estimates.

    ``cells``: rows (cell, n, sum of pair estimates, sum of word estimates).
    """
    prior = np.array([0.5, 0.4, 0.1])
    weights = np.tile(prior, (BUCKETS, 1))
    weights[0] = (0.0, 0.9, 0.1)                  # an unseen context has no pair estimate
    if not len(cells):
        return weights
    b, n = cells[:, 0].astype(np.int64) // (BINS * BINS), cells[:, 1]
    f = np.stack([cells[:, 2] / n, cells[:, 3] / n, np.full(len(n), 1 / (types + 1))], 1)
    for _ in range(ROUNDS):
        share = weights[b] * f
        share *= (n / share.sum(1))[:, None]
        total = np.stack([np.bincount(b, share[:, k], BUCKETS) for k in range(3)], 1) + prior
        total[0, 0] = 0.0
        weights = total / total.sum(1, keepdims=True)
    return weights


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _scores(weights: np.ndarray, types: int, tokens: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = _texts(left)
        word, pair = (_counts(right, k, "rest") + _counts(right, k, "own") for k in (WORD, PAIR))
        own, context = word[chunk.at[WORD]], word[chunk.context]
        l2, l1, l0 = weights[bucket(context)].T
        p = l2 * pair[chunk.at[PAIR]] / np.maximum(context, 1) + l1 * own / max(tokens, 1) + l0 / (types + 1)
        base = np.log10((own + 0.1) / (tokens + 0.1 * (types + 1)))
        add = lambda x: np.add.reduceat(x, chunk.first)     # noqa: E731
        return pa.table({"doc_id": left.column("doc_id"),
                         "held_out": pa.array(left.column("fold").to_numpy() == HELD_OUT), "n_tokens": chunk.length,
                         "n_known": add((own > 0).astype(np.int64)),
                         "train_tokens": np.full(len(chunk.length), tokens), "base_score": add(base),
                         "score": add(np.log10(p)) if tokens else np.zeros(len(chunk.length))})
    return run


def score(docs: DataFrame) -> DataFrame:
    """Base and model log10 probabilities of every whole text."""
    spark = docs.sparkSession
    rows = id_and_text(docs).select("doc_id", "text", fold(F.col("doc_id"), FOLDS).alias("fold"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    chunks = max(1, -(-size // CHUNK_BYTES))
    ranges = max(min(shuffle_partitions(spark), chunks), -(-size // RANGE_BYTES))
    dealt = (rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))
             .repartition(chunks, "chunk").persist(StorageLevel.MEMORY_AND_DISK))
    try:
        answers = pinned(dealt.groupBy("chunk").applyInArrow(_asked(ranges), ASKED)
                         .repartitionById(ranges, "range").mapInArrow(_answered, ANSWER))
        totals = answers.where(F.col("kind") == WORD).agg(
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("types", "tokens", "rest_types", "rest_tokens")]).first()

        def together(of, schema, *counts):
            named = answers.select(F.col("chunk").alias("to"), "range", "kind", *counts)
            return dealt.groupBy("chunk").cogroup(named.groupBy("to")).applyInArrow(of, schema)

        cells = together(_cells(totals.rest_tokens), CELLS, "rest").groupBy("cell").agg(
            *[F.sum(c).alias(c) for c in ("n", "pair", "word")]).collect()          # BUCKETS * BINS * BINS at most
        weights = learn_weights(np.array([tuple(r) for r in cells], np.float64).reshape(-1, 4), totals.rest_types)
        return pinned(together(_scores(weights, totals.types, totals.tokens), SCORES, "rest", "own"))
    finally:
        dealt.unpersist()
