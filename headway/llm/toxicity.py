"""Operator 8, toxicity: a linear-chain conditional random field over words.

Training reads labels of rows outside the held-out fold only, on a bounded,
documented sample: at most ``SAMPLE_ROWS`` documents of each label, drawn by a
hash of the id.  Inputs are a document's words, never its id, language, source
or label.

1. Features of a word: its lower-case form without punctuation at its ends, and
   its first 3 to 6 letters.  Candidates are features that toxic documents hold
   far more often than clean ones (at most ``CANDIDATES``).  Of these, a greedy
   cover takes the one that most toxic documents without a chosen feature hold,
   again and again; so words that copies of one toxic document happen to share
   are not taken for a mark.  Features of many toxic documents that are unlike
   each other join it (at most ``MAX_FEATURES``).
2. Words get labels: in a toxic document, those with a chosen feature are toxic;
   all others, and all of clean documents, are clean.
3. Segments of at most ``SEGMENT`` words (at most ``SEGMENTS``) train the field's
   emission and transition weights by conditional likelihood.
4. Every whole document: words without a feature share one emission, so a run of
   them is a power of one 2x2 matrix; forward and backward passes visit the other
   words alone.  The score is the probability that any of these is toxic; words
   with a marginal of a half or more are the offending spans (code points).

A null or empty text has no words and scores 0; texts of any length are scored
whole.  A score of exactly a half is predicted toxic.  Ties in the choice of features
go to the feature that comes first as text.  Without labels of both kinds, or
with empty tables, every score is 0.  Repeated rows score alike.  Beyond
``CANDIDATES`` and ``MAX_FEATURES`` those of the lowest odds times toxic documents are left
out.  Other columns are ignored by
``score`` and kept by ``keep_clean``.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import fold, id_and_text, pinned

FOLDS = 5
SAMPLE_ROWS = 5_000
CANDIDATES, MAX_FEATURES = 5_000, 1_000
SEGMENT, SEGMENTS = 32, 4_000
PREFIXES = (3, 4, 5, 6)
ENDS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
SIGNATURE = 32           # min-hashes of a toxic sample document
CHANCE = 4e6             # features that are tried, by the odds against one of them passing by chance
MIN_DOCS = 2             # toxic documents that a feature must newly cover
MIN_ODDS = 3.0           # log odds of a toxic against a clean document to hold a candidate
CACHE_ROWS = 500_000


def features(word: str) -> list[str]:
    """Features of a lower-case word."""
    core = word.strip(ENDS)
    return [core, *(core[:k] + "~" for k in PREFIXES if len(core) >= k)] if core else []


def sample_ids(labels: DataFrame, rows: int = SAMPLE_ROWS) -> list[tuple[int, int]]:
    """At most ``rows`` labelled ids outside the held-out fold of each label."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (fold(F.col("doc_id"), FOLDS) != 0))
    one = usable.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    picked = []
    for toxic, n in ((r.toxic, r.n) for r in one.groupBy("toxic").agg(F.count("*").alias("n")).collect()):
        # thinned by the hash first, so that tasks hand over about ``rows`` together
        thin = one.where((F.col("toxic") == toxic) & (F.pmod(F.xxhash64("doc_id"), F.lit(max(1, n // rows))) == 0))
        picked += thin.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).collect()
    return [(r.doc_id, r.toxic) for r in picked]


def train(docs: DataFrame, labels: DataFrame) -> dict | None:
    """The field's weights; None without labels of both kinds."""
    spark = docs.sparkSession
    ids = sample_ids(labels)
    if len({y for _, y in ids}) < 2:
        return None
    wanted = F.broadcast(spark.createDataFrame(ids, "doc_id long, toxic int"))      # bounded by SAMPLE_ROWS
    sample = pinned(id_and_text(docs).join(wanted, "doc_id").groupBy("doc_id")
                    .agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic"))
    totals = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return None
    names = _cover(sample, _candidates(sample, totals), totals)
    if not names:
        return None
    number = {f: k for k, f in enumerate(names)}
    weights = _fit([(r.labels, r.features) for r in _segments(sample, number).collect()], len(names))
    return {"number": number, **weights}


def _candidates(sample: DataFrame, totals: dict[int, int]) -> dict[str, int]:
    """feature -> clean documents of the sample that hold it, for features of high log odds."""
    def count(batches):
        toxic, clean = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                (toxic if label else clean).update({f for w in set(text.lower().split()) for f in features(w)})
        own = list(toxic.keys() | clean.keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(own, pa.string()), pa.array([toxic[f] for f in own], pa.int64()),
             pa.array([clean[f] for f in own], pa.int64())], ["feature", "toxic", "clean"])

    t, c = totals[1], totals[0]
    found = (sample.mapInArrow(count, "feature string, toxic long, clean long").groupBy("feature")
             .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
             .withColumn("odds", F.log((F.col("toxic") + 0.5) / (t + 1)) - F.log((F.col("clean") + 0.5) / (c + 1)))
             .where((F.col("toxic") >= MIN_DOCS) & (F.col("odds") > MIN_ODDS))
             .orderBy(F.desc(F.col("odds") * F.col("toxic")), "feature").limit(CANDIDATES))
    return {r.feature: r.clean for r in found.collect()}


def _cover(sample: DataFrame, clean: dict[str, int], totals: dict[int, int]) -> list[str]:
    """Marks among the candidates: a greedy cover of the toxic documents, and features of many unlike documents.

    The cover goes by newly covered toxic documents, less the clean ones.  Beyond
    it, a feature counts that no clean document holds, that more toxic ones hold
    than chance explains, and whose documents are no copies of each other (by
    min-hash signatures of their words).
    """
    def held(batches):
        import xxhash

        turns = np.arange(1, SIGNATURE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
        for batch in batches:
            own, signs = [], []
            for text in batch.column(0).to_pylist():
                words = set(text.lower().split())
                own.append(sorted({f for w in words for f in features(w) if f in clean}))
                h = np.array([xxhash.xxh3_64_intdigest(w) for w in words] or [0], np.uint64)
                signs.append(((h[:, None] * turns) >> np.uint64(32)).min(0).astype(np.int64).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.list_(pa.string())), pa.array(signs, pa.list_(pa.int64()))],
                                             ["held", "sign"])

    rows = sample.where("toxic = 1").select("text").mapInArrow(held, "held array<string>, sign array<bigint>").collect()
    bare = [set(r.held) for r in rows]
    sign = np.array([r.sign for r in rows])
    chosen: list[str] = []
    while len(chosen) < MAX_FEATURES:
        gain = Counter(f for own in bare for f in own)
        best = max(gain, key=lambda f: (gain[f] - 4 * clean[f], len(f), f), default=None)
        if best is None or gain[best] - 4 * clean[best] < MIN_DOCS:
            break
        chosen.append(best)
        bare = [own for own in bare if best not in own]
    toxic_share = totals[1] / (totals[0] + totals[1])
    many = math.ceil(math.log(CHANCE) / -math.log(toxic_share))
    where: dict[str, list[int]] = {}
    for k, r in enumerate(rows):
        for f in r.held:
            where.setdefault(f, []).append(k)
    for f in sorted(where, key=lambda f: (-len(where[f]), f)):
        if len(chosen) >= MAX_FEATURES or len(where[f]) < many:
            break
        if not clean[f]:
            some = sign[where[f][:: max(1, len(where[f]) // 12)][:12]]
            alike = (some[:, None, :] == some[None, :, :]).mean(2)
            if alike[np.triu_indices(len(some), 1)].mean() < 0.4:
                chosen.append(f)
    return sorted(set(chosen))


def _segments(sample: DataFrame, number: dict[str, int]) -> DataFrame:
    """Segments of labelled words: those with a feature, and the first of each document."""
    def cut(batches):
        for batch in batches:
            ys, fs = [], []
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = text.lower().split()
                for k in range(0, len(words), SEGMENT):
                    own = [features(w) for w in words[k:k + SEGMENT]]
                    held = [[number[f] for f in x if f in number] for x in own]
                    if k and not any(held):
                        continue
                    ys.append([int(bool(label and x)) for x in held])
                    fs.append(held)
            yield pa.RecordBatch.from_arrays([pa.array(ys, pa.list_(pa.int32())),
                                              pa.array(fs, pa.list_(pa.list_(pa.int32())))], ["labels", "features"])

    return (sample.mapInArrow(cut, "labels array<int>, features array<array<int>>")
            .orderBy(F.xxhash64("labels", "features")).limit(SEGMENTS))


def _fit(segments, n_features: int, steps: int = 120, rate: float = 0.15, decay: float = 1e-3) -> dict:
    """Weights of highest conditional likelihood (Adam on the exact gradient)."""
    segments = [s for s in segments if s[0]]
    n, longest = len(segments), max(len(y) for y, _ in segments)
    y = np.zeros((n, longest), np.int64)
    there = np.zeros((n, longest), bool)
    rows, cols, feats = [], [], []
    for i, (labels, held) in enumerate(segments):
        y[i, :len(labels)], there[i, :len(labels)] = labels, True
        for j, own in enumerate(held):
            for f in own:
                rows.append(i), cols.append(j), feats.append(f)
    rows, cols, feats = (np.array(x, np.int64) for x in (rows, cols, feats))
    w = np.zeros(n_features + 5)          # features, bias, start, and transitions 0->1, 1->0, 1->1
    m, v = np.zeros_like(w), np.zeros_like(w)
    words = there.sum()
    true = np.zeros_like(w)
    np.add.at(true, feats, y[rows, cols])
    pair = there[:, 1:]
    true[-5:] = (y[there].sum(), y[:, 0].sum(), ((y[:, :-1] == 0) & (y[:, 1:] == 1) & pair).sum(),
                 ((y[:, :-1] == 1) & (y[:, 1:] == 0) & pair).sum(), ((y[:, :-1] == 1) & (y[:, 1:] == 1) & pair).sum())
    for step in range(1, steps + 1):
        emit = np.full((n, longest), w[-5])
        np.add.at(emit, (rows, cols), w[feats])
        a = np.array([[0.0, w[-3]], [w[-2], w[-1]]])
        f = np.zeros((longest, n, 2))
        f[0, :, 1] = emit[:, 0] + w[-4]
        for t in range(1, longest):
            new = np.logaddexp(f[t - 1, :, :1] + a[0], f[t - 1, :, 1:] + a[1])
            new[:, 1] += emit[:, t]
            f[t] = np.where(there[:, t, None], new, f[t - 1])
        z = np.logaddexp(f[-1, :, 0], f[-1, :, 1])
        b = np.zeros((longest, n, 2))
        want = np.zeros_like(w)
        p = np.zeros((n, longest))
        for t in range(longest - 1, -1, -1):
            if t + 1 < longest:
                on = b[t + 1].copy()
                on[:, 1] += emit[:, t + 1]
                back = np.logaddexp(a[:, 0] + on[:, :1], a[:, 1] + on[:, 1:])
                b[t] = np.where(there[:, t + 1, None], back, b[t + 1])
                both = there[:, t + 1]
                for x, s, u in ((-3, 0, 1), (-2, 1, 0), (-1, 1, 1)):
                    want[x] += np.exp(f[t, both, s] + a[s, u] + on[both, u] - z[both]).sum()
            p[:, t] = np.where(there[:, t], np.exp(f[t, :, 1] + b[t, :, 1] - z), 0)
        np.add.at(want, feats, p[rows, cols])
        want[-5], want[-4] = p.sum(), p[:, 0].sum()
        g = (true - want) / max(1, len(segments)) - decay * w / max(1, math.sqrt(len(segments)))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w + rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return {"words": int(words), "weights": w[:-5].tolist(), "bias": float(w[-5]), "start": float(w[-4]),
            "moves": [[0.0, float(w[-3])], [float(w[-2]), float(w[-1])]]}


class Field:
    """Marginals of whole documents under trained weights."""

    def __init__(self, model: dict):
        number, weights = model["number"], model["weights"]
        self.weight = {f: weights[k] for f, k in number.items()}
        self.bias, self.start = model["bias"], model["start"]
        self.step = np.exp(np.array(model["moves"]))            # transition, then the emission of the word
        plain = self.step * np.array([1.0, math.exp(self.bias)])
        self.powers = [plain / plain.max()]
        for _ in range(40):
            p = self.powers[-1] @ self.powers[-1]
            self.powers.append(p / p.max())
        outer = self

        class Emissions(dict):
            def __missing__(self, word):
                if len(self) >= CACHE_ROWS:
                    self.clear()
                held = [outer.weight[f] for f in features(word) if f in outer.weight]
                value = self[word] = outer.bias + sum(held) if held else None
                return value

        self.emissions = Emissions()

    def _run(self, n: int) -> np.ndarray:
        """Up to scale, the matrix of n words without a feature."""
        out, k = np.eye(2), 0
        while n:
            if n & 1:
                out = out @ self.powers[k]
                out /= out.max()
            n >>= 1
            k += 1
        return out

    def marginals(self, words: list[str]) -> list[tuple[int, float]]:
        """(number of the word, probability that it is toxic) of the words with a feature."""
        emissions = list(map(self.emissions.__getitem__, words))
        at = [k for k, e in enumerate(emissions) if e is not None]
        if not at:
            return []
        forward, now = [], None
        last = -1
        for k in at:
            emit = np.array([1.0, math.exp(min(emissions[k], 500.0))])
            if now is None:
                # the first word takes the start weight instead of a transition
                if k == 0:
                    now = np.array([1.0, math.exp(self.start)]) * emit
                else:
                    now = np.array([1.0, math.exp(self.start + self.bias)]) @ self._run(k - 1) @ self.step * emit
            else:
                now = now @ self._run(k - last - 1) @ self.step * emit
            now = now / now.sum()
            forward.append(now)
            last = k
        out, back = [], self._run(len(words) - 1 - at[-1]) @ np.ones(2)
        for i in range(len(at) - 1, -1, -1):
            both = forward[i] * back
            out.append((at[i], float(both[1] / both.sum())))
            if i:
                emit = np.array([1.0, math.exp(min(emissions[at[i]], 500.0))])
                back = self._run(at[i] - at[i - 1] - 1) @ (self.step @ (emit * back))
                back = back / back.max()
        return out[::-1]

    def score(self, text: str) -> tuple[float, list[tuple[int, int]]]:
        """Probability that a word is toxic, and the offending spans."""
        found = self.marginals(text.lower().split())
        clean = 1.0
        for _, p in found:
            clean *= 1.0 - p
        bad = {k for k, p in found if p >= 0.5}
        spans = [m.span() for k, m in enumerate(re.finditer(r"\S+", text)) if k in bad] if bad else []
        return 1.0 - clean, spans


def _scorer(docs: DataFrame, labels: DataFrame):
    """Of a worker: text -> (score, spans)."""
    shared = docs.sparkSession.sparkContext.broadcast({"model": train(docs, labels)})    # MAX_FEATURES weights at most

    def scorer():
        own = shared.value
        if own["model"] is None:
            return lambda text: (0.0, [])
        if "field" not in own:
            own["field"] = Field(own["model"])
        return own["field"].score

    return scorer


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score, verdict and offending spans of every document."""
    scorer = _scorer(docs, labels)

    def run(batches):
        of = scorer()
        for batch in batches:
            found = [of(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([s for s, _ in found], pa.float64()),
                 pa.array([int(s >= 0.5) for s, _ in found], pa.int32()),
                 pa.array([",".join(f"{a}:{b}" for a, b in x) for _, x in found], pa.string())],
                ["doc_id", "held_out", "score", "predicted", "spans"])

    rows = id_and_text(docs).select("doc_id", (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, spans string")


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that score below a half."""
    scorer = _scorer(docs, labels)
    at = docs.columns.index("text")

    def run(batches):
        of = scorer()
        for batch in batches:
            yield batch.filter(pa.array([of(t or "")[0] < 0.5 for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
