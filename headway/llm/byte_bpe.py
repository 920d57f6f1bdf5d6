"""Operator 1, byte-level BPE by corpus-level merge replay.

A task takes the pre-tokens of a chunk of its documents that its worker does not
know yet and replays the merges on all of them at once: an inverted index leads
from each merge's rank to the positions of its pair in this small corpus; the
lowest rank is taken, all its positions are merged, and only the pairs with the
touched neighbours enter the index anew.  A rank with many positions is merged by
arrays.  Ids of known pre-tokens are cached per worker, in a bounded table.
Decoding joins the bytes of the ids.

A null text is empty and has no tokens.  Texts of any length are encoded whole.
Of equal pairs the leftmost merges first, as in the library.  Repeated rows give
repeated rows.  An empty table gives an empty result.  Columns other than doc_id and text are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from bisect import bisect_right

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from headway.llm.common import id_and_text, share_vocabulary

CACHE_ROWS = 600_000       # entries of a worker's table before it starts anew
MANY = 16                  # positions of a rank that are merged by arrays
CHUNK_CHARS = 4_000_000    # text of a chunk of documents; a longer document is a chunk of its own


class MergeReplay:
    """Ids of pre-tokens under a rank file (base64 token, rank per line)."""

    def __init__(self, file: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file.splitlines() if line)}
        self.token = {r: t for t, r in self.ranks.items()}
        self.bytes = [self.ranks[bytes([b])] for b in range(256)]
        # left id << 17 | right id -> id of what they merge to
        self.merged: dict[int, int] = {}
        get = self.ranks.get
        for token, rank in self.ranks.items():
            for k in range(1, len(token)):
                left, right = get(token[:k]), get(token[k:])
                if left is not None and right is not None:
                    self.merged[left << 17 | right] = rank
        of = np.array(self.bytes, np.int32)
        self.byte_id = of
        self.byte_pair = np.full((256, 256), -1, np.int32)
        for x in range(256):
            for y in range(256):
                self.byte_pair[x, y] = self.merged.get(int(of[x]) << 17 | int(of[y]), -1)
        keys, to = np.array([*self.merged], np.int64), np.array([*self.merged.values()], np.int32)
        left, right, most = (keys >> 17).astype(np.int32), (keys & (1 << 17) - 1).astype(np.int32), max(self.token)
        # what follows, or comes before, each id in a pair, and what they merge to
        self.follows, self.precedes = _pairs_by(left, right, to, most), _pairs_by(right, left, to, most)
        # ids that merge further to a lower rank than their own: a word with one must not go on with its other pairs
        self.unruly = {*left[to < left].tolist(), *right[to < right].tolist()}
        self.ranked = np.full(most + 1, -1, np.int32)       # by neighbour, filled for one merge at a time

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word.  A word that is a token is that token, as in the library."""
        return [np.frombuffer(p, "<u4").tolist() for p in self.packed(words)]

    def packed(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, as little-endian unsigned 32-bit integers."""
        out = [b""] * len(words)
        owner, whole = [], self.ranks.get
        for k, word in enumerate(words):
            rank = whole(word)
            if rank is not None:
                out[k] = rank.to_bytes(4, "little")
            elif word:
                owner.append(k)
        if owner:
            ids, starts = self._replay([words[k] for k in owner])
            left = ids >= 0
            ends = 4 * np.cumsum(np.add.reduceat(left, starts, dtype=np.int64))
            data, begin = ids[left].astype("<u4").tobytes(), 0
            for k, end in zip(owner, ends.tolist()):
                out[k] = data[begin:end]
                begin = end
        return out

    def _replay(self, words: list[bytes]) -> tuple[np.ndarray, list[int]]:
        """Merge all words at once; the ids by position (-1 where a token has been merged into the one before),
        the words' first positions."""
        data = np.frombuffer(b"".join(words), np.uint8)
        n = len(data)
        ends = np.cumsum([len(w) for w in words])
        starts = (ends - [len(w) for w in words]).tolist()
        rank = np.full(n, -1, np.int32)
        rank[:-1] = self.byte_pair[data[:-1], data[1:]]
        rank[ends - 1] = -1
        following, previous = np.arange(1, n + 1), np.arange(-1, n - 1)
        following[ends - 1] = -1
        previous[starts] = -1
        # read and written by position here, and by many positions through `arrays`
        ids, after, before = _array(self.byte_id[data]), _array(following), _array(previous)
        now = _array(rank)              # rank of the pair that begins at each position, -1 if there is none
        arrays = [np.frombuffer(x, np.int32) for x in (ids, after, before, now)]
        # the inverted index: rank -> positions of pairs that merge to it
        at = np.flatnonzero(rank >= 0)
        at = at[np.argsort(rank[at], kind="stable")]
        found, first = np.unique(rank[at], return_index=True)
        index = dict(zip(found.tolist(), (x.tolist() for x in np.split(at, first[1:])))) if len(at) else {}
        heap = list(index)              # sorted, so a heap
        merged, push = self.merged.get, heapq.heappush
        while heap:
            rank = heapq.heappop(heap)
            positions = index.pop(rank)
            if len(positions) >= MANY and rank not in self.unruly:
                fresh = self._merge_all(rank, positions, *arrays)
                if fresh is not None:
                    for new, at in fresh:
                        if new in index:
                            index[new].append(at)
                        else:
                            index[new] = [at]
                            push(heap, new)
                    continue
            positions.sort()
            held = -1                   # up to here, a word waits for a lower rank that has come up in it
            for at in positions:
                if now[at] != rank:
                    continue            # a merge before has taken one of the two
                if at < held:
                    if rank in index:
                        index[rank].append(at)
                    else:
                        index[rank] = [at]
                        push(heap, rank)
                    continue
                gone = after[at]
                beyond, left, least = after[gone], before[at], rank
                ids[at], ids[gone], now[gone], after[at], new = rank, -1, -1, beyond, -1
                if beyond >= 0:
                    before[beyond] = at
                    new = merged(rank << 17 | ids[beyond], -1)
                    if new >= 0:
                        if new in index:
                            index[new].append(at)
                        else:
                            index[new] = [at]
                            push(heap, new)
                        if new < least:
                            least = new
                now[at] = new
                if left >= 0:
                    new = now[left] = merged(ids[left] << 17 | rank, -1)
                    if new >= 0:
                        if new in index:
                            index[new].append(left)
                        else:
                            index[new] = [left]
                            push(heap, new)
                        if new < least:
                            least = new
                if least < rank:
                    k = bisect_right(starts, at)
                    held = starts[k] if k < len(starts) else n
        return arrays[0], starts

    def _merge_all(self, rank: int, positions: list[int], ids, after, before, now):
        """Merge the pairs of a rank at all its positions; the ranks and positions of the new pairs that merge further.

        None, and nothing done, if two of the pairs share a token: then their order counts.
        """
        at = np.sort(np.array(positions, np.int32))
        at = at[(now[at] == rank) & np.append(at[1:] != at[:-1], True)]
        gone = after[at]
        if (now[gone] == rank).any():
            return None
        beyond = after[gone]
        ids[at], ids[gone], now[gone], after[at] = rank, -1, -1, beyond
        inner = beyond >= 0
        before[beyond[inner]] = at[inner]
        now[at] = -1
        ends, left = at[inner], before[at]
        left = left[left >= 0]
        # the left neighbours' pairs come last: where one is itself of this merge, both ways give the same
        for pairs, here, neighbour in ((self.follows, ends, beyond[inner]), (self.precedes, left, left)):
            starts, others, to = pairs
            own = slice(starts[rank], starts[rank + 1])
            self.ranked[others[own]] = to[own]
            now[here] = self.ranked[ids[neighbour]]
            self.ranked[others[own]] = -1
        touched = np.concatenate([ends, left])
        new = now[touched]
        further = new >= 0
        return zip(new[further].tolist(), touched[further].tolist())


def _array(values: np.ndarray) -> array:
    """Compact integers that are read one by one faster than numpy's."""
    return array("i", values.astype(np.int32).tobytes())


def _pairs_by(one: np.ndarray, other: np.ndarray, to: np.ndarray, most: int) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Pairs in the order of one side's ids: where each id's pairs begin, their other sides, what they merge to."""
    order = np.argsort(one, kind="stable")
    return np.searchsorted(one[order], np.arange(most + 2)).tolist(), other[order], to[order]


class Encoder:
    """Texts to packed ids (little-endian unsigned 32-bit), with the worker's table of pre-tokens."""

    def __init__(self, file: bytes, pattern: str):
        import regex

        self.replay = MergeReplay(file)
        self.pieces = regex.compile(pattern).findall
        self.words: dict[str, bytes] = {}        # pre-token -> packed ids

    def _learn(self, met: set[str]) -> None:
        """Enter the pre-tokens of a chunk that the table lacks; a full table keeps those that the chunk has."""
        words = self.words
        new = sorted(met.difference(words))
        if len(words) + len(new) > CACHE_ROWS:
            words = self.words = {w: words[w] for w in met.intersection(words)}
        words.update(zip(new, self.replay.packed([w.encode() for w in new])))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        parts = [self.pieces(text) for text in texts]
        self._learn(set().union(*parts))
        ids = self.words.__getitem__
        return [b"".join(map(ids, own)) for own in parts]

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.replay.token.__getitem__, np.frombuffer(packed, "<u4").tolist()))


def chunked(rows, chars: int = CHUNK_CHARS):
    """Lists of (id, text) of about ``chars`` characters."""
    own, n = [], 0
    for row in rows:
        own.append(row)
        n += len(row[1])
        if n >= chars:
            yield own
            own, n = [], 0
    if own:
        yield own


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, ids): the ids of every whole text as little-endian unsigned 32-bit integers."""
    return _mapped(docs, path, pattern, lambda encoder, ids: (ids,), [("ids", pa.binary(), "binary")])


def round_trip(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text."""
    def digests(encoder, ids):
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(encoder.decode(ids)).hexdigest()

    return _mapped(docs, path, pattern, digests, [("n_tokens", pa.int64(), "long"), ("ids_sha256", pa.string(), "string"),
                                                  ("decoded_sha256", pa.string(), "string")])


def _mapped(docs, path, pattern, of, columns) -> DataFrame:
    pattern = pattern or public_tokenizers.PATTERN
    shared = share_vocabulary(docs.sparkSession, path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    names = ["doc_id", *(c[0] for c in columns)]
    types = [pa.int64(), *(c[1] for c in columns)]

    def run(batches):
        own = shared.value
        if "encoder" not in own:
            own["encoder"] = Encoder(own["file"], pattern)
        encoder = own["encoder"]
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for part in chunked(rows):
                packed = encoder.encode([t for _, t in part])
                cols = zip(*((i, *of(encoder, p)) for (i, _), p in zip(part, packed)))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    return id_and_text(docs).mapInArrow(run, "doc_id long, " + ", ".join(f"{c[0]} {c[2]}" for c in columns))


def decode_documents(ids: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, data): the bytes that the ids of ``encode_documents`` stand for."""
    shared = share_vocabulary(ids.sparkSession, path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))

    def run(batches):
        own = shared.value
        if "tokens" not in own:
            own["tokens"] = {int(b): base64.b64decode(a) for a, b in map(bytes.split, own["file"].splitlines())}
        token = own["tokens"].__getitem__
        for batch in batches:
            data = [b"".join(map(token, np.frombuffer(p or b"", "<u4").tolist())) for p in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["doc_id", "data"])

    return ids.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary")
