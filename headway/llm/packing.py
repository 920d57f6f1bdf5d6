"""Operator 10, best-two-fit packing of token sequences.

1. Every document is encoded in its map task; longer ones are cut into pieces of
   at most ``capacity`` tokens.  Only narrow rows (id, piece, length, checksum)
   leave the task.
2. The pieces' lengths are counted: at most ``capacity`` rows, whatever the
   number of documents.  From these counts the driver makes *templates*: a bin
   is filled greedily (largest length that fits, again and again); then, as long
   as two lengths that are still unpacked fill the gap left by taking out the
   bin's smallest document more tightly, they replace it.  One template stands
   for as many bins as the counts allow, so the work is bounded by the number of
   different lengths, not by the number of documents.
3. The k-th piece of a length takes the k-th place of that length.  Ranks come
   from windows over (length, salt) and prefix sums over the salts, so a length
   that a third of all documents share is spread over ``SALTS`` groups.

A null or empty text is a document of the end id alone.  Repeated rows are
packed as documents of their own.  An empty table gives an empty result.
Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import id_and_text, pinned, share_vocabulary
from headway.llm.wordpiece import TokenCache

CAPACITY = 4096
END_ID = 1
SALTS = 64
PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long"


def _as_bytes(ids) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


def token_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
                 with_ids: bool = False) -> DataFrame:
    """One row per piece of each document; ``with_ids`` adds the ids themselves (little-endian 32-bit)."""
    shared = share_vocabulary(docs.sparkSession, path or public_tokenizers.path("word_bpe_49k.json"))
    end, width = _as_bytes([end_id]), 4 * capacity

    def cut(batches):
        own = shared.value
        if "ids" not in own:
            own["ids"] = TokenCache(own["file"], _as_bytes)
        cache = own["ids"]
        get = cache.__getitem__
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = b"".join(map(get, cache.split(text))) + end
                for k in range(0, len(data), width):
                    part = data[k:k + width]
                    rows.append((doc_id, k // width, k // 4, len(part) // 4, zlib.crc32(part),
                                 *((part,) if with_ids else ())))
            cols = list(zip(*rows)) or [()] * (5 + with_ids)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names[:len(cols)])

    return id_and_text(docs).mapInArrow(cut, PIECES + (", ids binary" if with_ids else ""))


def templates(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """Best-two-fit on counts of lengths: (number of bins, lengths in one bin), until every piece is packed."""
    left = {n: c for n, c in counts.items() if c > 0}
    order = sorted(left)
    made = []

    def available(n: int, used: dict[int, int]) -> int:
        return left.get(n, 0) - used.get(n, 0)

    def largest(most: int, used: dict[int, int], least: int = 1) -> int:
        """The largest unpacked length from ``least`` to ``most``; 0 if there is none."""
        k = bisect_right(order, most) - 1
        while k >= 0 and order[k] >= least:
            if available(order[k], used) > 0:
                return order[k]
            k -= 1
        return 0

    while order:
        used: dict[int, int] = {}
        bin_, gap = [], capacity
        while gap and (n := largest(gap, used)):
            bin_.append(n)
            used[n] = used.get(n, 0) + 1
            gap -= n
        while gap and bin_:
            small = min(bin_)
            room, best, pair = gap + small, small, None
            # a runs from the largest length below room down to half of it, b is the best partner
            k = bisect_left(order, room) - 1
            while k >= 0 and 2 * order[k] >= best and best < room:
                a = order[k]
                if available(a, used) > 0:
                    trial = dict(used)
                    trial[a] = trial.get(a, 0) + 1
                    b = largest(min(room - a, a), trial, max(1, best - a + 1))
                    if b and a + b > best:
                        best, pair = a + b, (a, b)
                k -= 1
            if not pair:
                break
            bin_.remove(small)
            used[small] -= 1
            for n in pair:
                bin_.append(n)
                used[n] = used.get(n, 0) + 1
            gap = room - best
        used = {n: c for n, c in used.items() if c}
        times = min(left[n] // c for n, c in used.items())
        made.append((times, sorted(bin_, reverse=True)))
        for n, c in used.items():
            left[n] -= times * c
            if not left[n]:
                del left[n]
                del order[bisect_left(order, n)]
    return made


def places(made: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, end rank, first sequence, places per sequence, place's number, offset) by length."""
    seen: dict[int, int] = {}
    rows, sequence = [], 0
    for times, bin_ in made:
        offset, own = 0, {}
        for n in bin_:
            own.setdefault(n, []).append(offset)
            offset += n
        for n, offsets in own.items():
            first = seen.get(n, 0)
            seen[n] = first + times * len(offsets)
            rows.append((n, first, seen[n], sequence, offsets))
        sequence += times
    return rows


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Every piece with its sequence and its offset there."""
    return place_pieces(pinned(token_pieces(docs, path, capacity, end_id)), capacity)


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pack rows with a ``length`` of at most ``capacity``; pieces must be a stable (checkpointed) frame."""
    spark = pieces.sparkSession
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SALTS)).cast("int"))
    tallies = pinned(salted.groupBy("length", "_salt").agg(F.count("*").alias("_n")))   # capacity x SALTS rows at most
    counts = {r.length: r.n for r in tallies.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    rows = places(templates(counts, capacity))
    table = spark.sparkContext.broadcast(_lookup(rows))   # bounded by the lengths and templates, not by documents
    before = tallies.select(
        "length", "_salt", (F.sum("_n").over(Window.partitionBy("length").orderBy("_salt")) - F.col("_n")).alias("_before"))
    order = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (salted.withColumn("_rank", F.row_number().over(order) - 1)
              .join(before, ["length", "_salt"])
              .select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
                      (F.col("_rank") + F.col("_before")).alias("rank")))

    def locate(batches):
        starts, first, end, seq, per, off0, offsets = table.value
        for batch in batches:
            length = batch.column(3).to_numpy()
            rank = batch.column(5).to_numpy()
            row = np.zeros(len(length), np.int64)
            for n in np.unique(length):
                at = length == n
                lo, hi = starts[n], starts[n + 1]
                row[at] = lo + np.searchsorted(first[lo:hi], rank[at], "right") - 1
            k = rank - first[row]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(5)), pa.array(seq[row] + k // per[row]),
                 pa.array(offsets[off0[row] + k % per[row]])],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(
        locate, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def _lookup(rows):
    rows = sorted(rows, key=lambda r: (r[0], r[1]))
    n = np.array([r[0] for r in rows], np.int64)
    per = np.array([len(r[4]) for r in rows], np.int64)
    starts = np.searchsorted(n, np.arange((int(n.max()) if len(n) else 0) + 2))
    cols = [np.array([r[k] for r in rows], np.int64) for k in (1, 2, 3)]
    flat = np.array([o for r in rows for o in r[4]], np.int64)
    return starts, *cols, per, np.cumsum(per) - per, flat
