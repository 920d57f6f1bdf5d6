"""Operator 6, exact self-join on the Jaccard similarity of word shingles, by universe partition.

Two sets of sizes a and b with similarity of at least p per cent differ in at
most H = (100-p)(a+b)/(100+p) shingles.  The universe of hashed shingles is
partitioned into m > H ranges, m by the size band of the smaller set.  By the
pigeonhole principle, thresholds t of segments with the sum of (t+1) above H
leave a segment in which the sets differ in at most t shingles.

* Index: a document emits a key per segment of its own band's partition, and in
  the first few segments also the keys of the segment less one shingle (the
  one-deletion neighbourhood).  A key is a sum over the segment's shingles, so
  all deletions cost one subtraction each.
* Probe: as the larger set, it chooses per band the cheapest thresholds of -1, 0
  or 1 that suffice: segments with rare shingles first, then one-deletions of
  such segments, then segments whose shingles are all frequent (by a bounded
  sample of the corpus, which changes costs, never results), at last empty
  segments.  Keys of empty segments are salted in the index, since many
  documents share them, and probed under every salt.
* Keys travel in packed blocks, one per map task and key range; a task sorts the
  keys of its range and finds those that meet.
* Verification is exact, on the shingles of whole texts.  Of many documents under
  one key (a run), each is first compared with the smallest id and, under some
  keys, with another one by a hash.  The links so found are closed; then runs that
  still hold several components are compared whole, in tiles of bounded size,
  and no task emits more than a spanning forest of a tile:
  1. Bit sketches of the sets bound their intersection from above, so what
     cannot be a link is seen without the sets.  Of the pairs left, those that
     would join components (one a component) are verified, and closed.
  2. Documents that sketches still connect across components (pairs just below
     the limit) are gathered with all such partners, a row per document, and
     verified exactly in turns, those that are in different components by then.
  So no link that could join two components is left out, and rows grow with the
  members of runs, not with their pairs.

Documents with equal shingle sets form a class, whose smallest id stands for it.
Shingles are compared by 64-bit hashes.

Null or empty texts and texts without words have no shingles and are linked with
nothing.  Rows that share an id are one vertex; rows without an id take no part
and have no component.  Texts of any length count whole; repeated rows are rows of
the same component; similarity of exactly the limit links.  An empty table gives
an empty result.  Columns other than doc_id and text are ignored by ``join`` and
kept by ``keep_one``, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.common import id_and_text, pinned, shuffle_partitions

WIDTH, PERCENT = 5, 80
BAND = 1.5                    # largest by smallest size of a band
EMPTY_SALTS = 64
SAMPLE_DOCS, COMMON = 20_000, 200_000
BLOCK_KEYS = 1_000_000        # keys that a map task gathers before it emits them
RANGE_BYTES = 20_000_000      # text bytes per key range
SMALL_RUN = 8
PARTNER_RUNS = 6              # in one of so many larger runs, each document also meets one by a hash
PER_HOME = 1_000              # pairs that are verified together
TASK_ROWS, LEAST_TASKS = 20_000, 8      # pairs or links that a task is given at least, where tasks would be more than the second
SKETCH_BITS = 4               # of a sketch per shingle, at least
TILE = 1_024                  # members of a run in a block; a tile compares two blocks
TURN = 8                      # undecided partners of a document that the first turn verifies
BROADCAST_ROWS = 500_000      # of 16 bytes
CACHE_ROWS = 400_000

PROBE, INDEX, DELETED = 1, 2, 4
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
                              0xC2B2AE3D27D4EB4F)]


def mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = (x ^ (x >> np.uint64(30))) * MIX[1]
    x = (x ^ (x >> np.uint64(27))) * MIX[2]
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_ROWS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str, hashes: WordHashes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles."""
    words = text.encode().lower().split()        # of bytes: A-Z alone; space and U+0009 to U+000D
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    size = min(n, width)
    out = np.full(n - size + 1, size, np.uint64) * MIX[0]
    for k in range(size):
        out += mixed(h[k:n - size + 1 + k] + np.uint64(int(MIX[3]) * (k + 1) % 2 ** 64)) * MIX[(k % 2) * 3 + 1]
        out = (out << np.uint64(7)) | (out >> np.uint64(57))
    return np.unique(mixed(out))


def sketch(u: np.ndarray) -> bytes:
    """Bits of a set's hashes modulo a power of two of at least SKETCH_BITS per shingle."""
    bits = max(64, 1 << (SKETCH_BITS * max(len(u), 1) - 1).bit_length())
    out = np.zeros(bits, np.uint8)
    out[(u & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(out, bitorder="little").tobytes()


class Bands:
    """Size bands and their partitions."""

    def __init__(self, percent: int = PERCENT):
        self.percent = percent
        self.edges = [1]
        while self.edges[-1] < 2 ** 31:
            low = self.edges[-1]
            self.edges.append(max(low + 1, int(low * BAND) + 1))
        self.high = [e - 1 for e in self.edges[1:]]
        self.partitions: dict[int, tuple] = {}

    def distance(self, a: int, b: int) -> int:
        """The most shingles in which sets of these sizes can differ."""
        return (100 - self.percent) * (a + b) // (100 + self.percent)

    def of(self, size: int) -> int:
        return int(np.searchsorted(self.edges, size, "right")) - 1

    def partition(self, band: int) -> tuple[int, int, np.ndarray, np.ndarray]:
        """Segments, segments with one-deletions, bounds of the segments, salts of their keys."""
        if band not in self.partitions:
            high = self.high[band]
            m = self.distance(high, high * 100 // self.percent) + 1
            deletable = m if m <= 8 else 4 + m // 25
            at = np.arange(1, m, dtype=np.float64) / m
            bounds = (at * 2.0 ** 64).astype(np.uint64)
            salts = mixed(np.arange(m, dtype=np.uint64) + np.uint64(band << 40) + MIX[4])
            self.partitions[band] = (m, deletable, bounds, salts)
        return self.partitions[band]

    def keys(self, u: np.ndarray, rare: np.ndarray, salt: int):
        """Keys and flags of a set: ``u`` its sorted hashes, ``rare`` which of them are not frequent."""
        n, parts = len(u), []
        token = mixed(u ^ MIX[3])
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(token)])
        rares = np.concatenate([np.zeros(1, np.int64), np.cumsum(rare)])
        own = self.of(n)
        for band in range(own, -1, -1):
            if 100 * self.high[band] < self.percent * n:
                break
            m, deletable, bounds, salts = self.partition(band)
            at = np.concatenate([[0], np.searchsorted(u, bounds), [n]])
            size, fresh = np.diff(at), np.diff(rares[at])
            sums = total[at[1:]] - total[at[:-1]]
            need = self.distance(n, min(n, self.high[band])) + 1
            flag0, flag1, empty = self._choose(size, fresh, deletable, need)
            index = INDEX if band == own else 0
            # whole segments
            flags = flag0 | np.where(size > 0, index, 0).astype(np.uint8)
            on = np.flatnonzero((flags > 0) & (size > 0))
            parts.append((mixed(sums[on] + salts[on]), flags[on]))
            # one-deletions in the first segments
            end = at[deletable]
            if end:
                seg = np.repeat(np.arange(deletable), size[:deletable])
                flags = (flag1[seg] | index).astype(np.uint8)
                on = np.flatnonzero(flags)
                if len(on):
                    keys = mixed(sums[seg[on]] - token[on] + salts[seg[on]])
                    # a segment less its only shingle is an empty one
                    lone = size[seg[on]] == 1
                    keys[lone] = mixed(keys[lone] + np.uint64(salt + 1))
                    parts.append((keys, flags[on] | DELETED))
                    if lone.any() and (flags[on][lone] & PROBE).any():
                        parts.append(self._all_salts(salts[seg[on][lone & ((flags[on] & PROBE) > 0)]], DELETED))
            none = np.flatnonzero(size == 0)
            if index and len(none):
                keys = mixed(mixed(salts[none]) + np.uint64(salt + 1))
                parts.append((keys, np.full(len(none), INDEX, np.uint8)))
            if len(empty):
                parts.append(self._all_salts(salts[empty], 0))
        return np.concatenate([k for k, _ in parts]), np.concatenate([f for _, f in parts])

    @staticmethod
    def _all_salts(salts: np.ndarray, more: int):
        every = np.arange(1, EMPTY_SALTS + 1, dtype=np.uint64)
        keys = mixed((mixed(salts)[:, None] + every[None, :]).ravel())
        return keys, np.full(len(keys), PROBE | more, np.uint8)

    @staticmethod
    def _choose(size, fresh, deletable: int, need: int):
        """Cheapest thresholds whose sum of (t+1) is ``need``: flags of t >= 0 and t = 1, and empty segments."""
        flag0, flag1 = np.zeros(len(size), np.uint8), np.zeros(len(size), np.uint8)
        order = np.lexsort((-size, -fresh))
        good = order[:int((fresh > 0).sum())]
        take = good[:need]
        flag0[take] = PROBE
        need -= len(take)
        if need > 0:
            twice = [s for s in good if s < deletable and fresh[s] > 1][:need]
            flag1[twice] = PROBE
            need -= len(twice)
        if need > 0:
            rest = order[len(good):int((size > 0).sum())][:need]
            flag0[rest] = PROBE
            need -= len(rest)
        if need > 0:
            twice = [s for s in order if s < deletable and size[s] > 0 and not flag1[s]][:need]
            flag1[twice] = PROBE
            need -= len(twice)
        empty = np.flatnonzero(size == 0)[:need] if need > 0 else np.empty(0, np.int64)
        return flag0, flag1, empty


def common_shingles(docs: DataFrame, n_docs: int) -> np.ndarray:
    """Shingles of three or more documents of a sample by a hash of the id, about SAMPLE_DOCS; at most COMMON, sorted."""
    parts = max(1, n_docs // SAMPLE_DOCS)
    sample = id_and_text(docs).where(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) == 0)

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            own = [shingles(t, hashes) for t in batch.column(0).to_pylist()]
            flat = np.concatenate(own) if own else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(flat.view(np.int64))], ["h"])

    held = (sample.select("text").mapInArrow(run, "h long").groupBy("h").agg(F.count("*").alias("n"))
            .where("n >= 3").orderBy(F.desc("n"), "h").limit(COMMON))
    return np.sort(np.array([r.h for r in held.select("h").collect()], np.int64).view(np.uint64))


BLOCK = "range int, keys binary, at binary, flags binary, ids binary, sizes binary"
FOUND = "kind int, x long, y long, ids binary, sizes binary, flags binary"


def _blocks(docs: DataFrame, common, ranges: int, percent: int) -> DataFrame:
    """Packed keys by key range; rows of documents (id, size, fingerprint, sketch if indexed) go with them."""
    def run(batches):
        hashes, bands, frequent = WordHashes(), Bands(percent), common.value
        seen: set[bytes] = set()
        keys, flags, counts, ids, sizes = [], [], [], [], []
        table: list[tuple[int, int, bytes, bytes]] = []

        def emit():
            rows = []
            if keys:
                k, f = np.concatenate(keys), np.concatenate(flags)
                at = np.repeat(np.arange(len(ids), dtype=np.uint32), counts)
                where = ((k >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
                order = np.argsort(where, kind="stable")
                cuts = np.searchsorted(where[order], np.arange(ranges + 1))
                own_ids, own_sizes = np.array(ids, np.int64), np.array(sizes, np.uint32)
                for r in range(ranges):
                    on = order[cuts[r]:cuts[r + 1]]
                    if len(on):
                        held, place = np.unique(at[on], return_inverse=True)
                        rows.append((r, k[on].tobytes(), place.astype(np.uint32).tobytes(), f[on].tobytes(),
                                     own_ids[held].tobytes(), own_sizes[held].tobytes()))
            if table:
                where = [xxhash.xxh3_64_intdigest(fp) % ranges for _, _, fp, _ in table]
                for r in set(where):
                    own = [x for x, w in zip(table, where) if w == r]
                    rows.append((r, b"", b"".join(x[3] for x in own), b"".join(x[2] for x in own),
                                 np.array([x[0] for x in own], np.int64).tobytes(),
                                 np.array([(x[1], len(x[3])) for x in own], np.uint32).tobytes()))
            for x in (keys, flags, counts, ids, sizes, table):
                x.clear()
            for row in rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], t) for v, t in zip(row, (pa.int32(), *[pa.binary()] * 5))],
                    ["range", "keys", "at", "flags", "ids", "sizes"])

        held = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if doc_id is None:
                    continue
                u = shingles(text, hashes)
                fp = xxhash.xxh3_128_digest(u.tobytes())
                if not len(u) or fp in seen:
                    table.append((doc_id, len(u), fp, b""))
                    held += 8
                else:
                    seen.add(fp)
                    bits = sketch(u)
                    table.append((doc_id, len(u), fp, bits))
                    held += len(bits) // 16
                    rare = np.ones(len(u), np.int64)
                    if len(frequent):
                        rare = (frequent[np.minimum(np.searchsorted(frequent, u), len(frequent) - 1)] != u).astype(np.int64)
                    k, f = bands.keys(u, rare, xxhash.xxh3_64_intdigest(fp) % EMPTY_SALTS)
                    keys.append(k), flags.append(f), counts.append(len(k)), ids.append(doc_id), sizes.append(len(u))
                    held += len(k)
                if held >= BLOCK_KEYS:
                    yield from emit()
                    held = 0
        yield from emit()

    return id_and_text(docs).mapInArrow(run, BLOCK)


def _meet(blocks: DataFrame, percent: int) -> DataFrame:
    """Documents that meet under a key: kind 0 document rows (fingerprint as ``ids``, sketch as ``sizes``), 1 pairs, 2 runs."""
    def run(batches):
        keys, flags, ids, sizes, docs = [], [], [], [], []
        for batch in batches:
            for k, at, f, i, s in zip(*(batch.column(c).to_pylist() for c in range(1, 6))):
                own, size = np.frombuffer(i, np.int64), np.frombuffer(s, np.uint32)
                if not k:
                    docs.append((own, size.reshape(-1, 2), f, at))
                    continue
                place = np.frombuffer(at, np.uint32)
                keys.append(np.frombuffer(k, np.uint64)), flags.append(np.frombuffer(f, np.uint8))
                ids.append(own[place]), sizes.append(size[place])
        for own, size, f, bits in docs:
            n, end = len(own), np.cumsum(size[:, 1])
            yield _batch([0] * n, own, size[:, 0].astype(np.int64), [f[16 * j:16 * j + 16] for j in range(n)],
                         [bits[e - w:e] for e, w in zip(end.tolist(), size[:, 1].tolist())], [b""] * n)
        docs.clear()
        if not keys:
            return
        key = np.concatenate(keys)
        keys.clear()
        order = np.argsort(key, kind="stable")
        key = key[order]
        same = key[1:] == key[:-1]
        on = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same]))
        key, order = key[on], order[on]
        f, d, s = (np.concatenate(x)[order] for x in (flags, ids, sizes))
        if not len(key):
            return
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        length = np.diff(np.concatenate([start, [len(key)]]))
        # runs without a probe or without an index entry find nothing
        useful = (np.maximum.reduceat(f & PROBE, start) > 0) & (np.maximum.reduceat(f & INDEX, start) > 0)
        a, b = [], []
        member = np.repeat(useful & (length <= SMALL_RUN), length)
        kk, ff, dd, ss = key[member], f[member], d[member], s[member]
        for j in range(1, SMALL_RUN):
            if len(kk) <= j:
                break
            x = np.flatnonzero(kk[j:] == kk[:-j])
            x = x[_valid(ff[x], ss[x], dd[x], ff[x + j], ss[x + j], dd[x + j], percent)]
            a.append(np.minimum(dd[x], dd[x + j])), b.append(np.maximum(dd[x], dd[x + j]))
        runs: dict[bytes, tuple] = {}
        for r in np.flatnonzero(useful & (length > SMALL_RUN)):
            x = slice(start[r], start[r] + length[r])
            own, size, flag = d[x], s[x], f[x]
            first = np.lexsort((size, own))         # rows that share an id are one member for each size
            own, size, flag = own[first], size[first], flag[first]
            once = np.concatenate([[True], (own[1:] != own[:-1]) | (size[1:] != size[:-1])])
            flag = np.bitwise_or.reduceat(flag, np.flatnonzero(once)) & ~np.uint8(DELETED)
            own, size = own[once], size[once]
            if len(own) < 2:
                continue
            near = np.flatnonzero(_near(size[0], size[1:], percent)) + 1
            a.append(np.full(len(near), own[0])), b.append(own[near])
            name = xxhash.xxh3_64_digest(own.tobytes() + flag.tobytes())
            if name[0] % PARTNER_RUNS == 0 and name not in runs:
                other = _partners(own, size, name, percent)
                a.append(np.minimum(own, own[other])), b.append(np.maximum(own, own[other]))
            runs[name] = (own, size, flag)
        if a:
            pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], 1), axis=0)
            pairs = pairs[pairs[:, 0] != pairs[:, 1]]
            n = len(pairs)
            yield _batch([1] * n, pairs[:, 0], pairs[:, 1], *[[b""] * n] * 3)
        for name, (own, size, flag) in runs.items():
            yield _batch([2], [int.from_bytes(name, "little", signed=True)], [len(own)], [own.tobytes()],
                         [size.astype(np.uint32).tobytes()], [flag.tobytes()])

    return blocks.mapInArrow(run, FOUND)


def _batch(kind, x, y, *blobs):
    return pa.RecordBatch.from_arrays(
        [pa.array(kind, pa.int32()), pa.array(x, pa.int64()), pa.array(y, pa.int64()), *(pa.array(c, pa.binary()) for c in blobs)],
        ["kind", "x", "y", "ids", "sizes", "flags"])


def _near(a, b, percent: int):
    """Whether sets of these sizes can be similar enough."""
    a, b = np.asarray(a, np.int64), np.asarray(b, np.int64)
    return 100 * np.minimum(a, b) >= percent * np.maximum(a, b)


def _valid(f, s, d, g, t, e, percent: int):
    """Whether a pair meets as probe (the larger one) and index, not by deletions of both."""
    left = ((f & PROBE) > 0) & ((g & INDEX) > 0) & (s >= t)
    right = ((g & PROBE) > 0) & ((f & INDEX) > 0) & (t >= s)
    return (left | right) & ~((f & g & DELETED) > 0) & (d != e) & _near(s, t, percent)


def _open_tiles(runs: DataFrame, parts: DataFrame) -> DataFrame:
    """Members of runs that hold several components so far, one row per tile they belong to.

    A run is dealt by a hash of the ids into blocks of about TILE members; a tile
    is a pair of blocks, so each member is in as many tiles as there are blocks.
    """
    flat = runs.select(F.col("x").alias("run"), F.col("y").alias("members"), "ids", "sizes", "flags").mapInArrow(
        _flatten, "run long, members long, doc_id long, size int, flag int")
    known = flat.join(parts, "doc_id", "left").withColumn("part", F.coalesce("component_id", "doc_id"))
    open_ = known.groupBy("run").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi").select("run")
    blocks = F.ceil(F.col("members") / TILE)
    return (known.join(open_, "run", "left_semi")
            .withColumn("block", F.pmod(F.xxhash64("doc_id"), blocks).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), blocks.cast("int") - 1)))
            .select("run", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
                    "doc_id", "size", "flag", "part", "block"))


class _Tile:
    """Members of a tile by size, and those that may be linked across components, by a bound on each pair's intersection."""

    def __init__(self, t: pa.Table, percent: int):
        order = np.argsort(t.column("size").to_numpy(), kind="stable")
        self.d, self.f, self.c, self.block = (t.column(x).to_numpy()[order] for x in ("doc_id", "flag", "part", "block"))
        self.size = t.column("size").to_numpy()[order].astype(np.int64)
        self.c = self.c.copy()
        self.order, self.percent = order, percent
        self.last = np.searchsorted(self.size, self.size * 100 // percent, "right")
        self.across = t.column("lo")[0].as_py() != t.column("hi")[0].as_py()

    def met(self, i: int) -> np.ndarray:
        """Larger members of other components that meet i as probe and index."""
        j = np.arange(i + 1, self.last[i])
        j = j[self.c[j] != self.c[i]]
        if self.across:
            j = j[self.block[j] != self.block[i]]
        return j[_valid(self.f[j], self.size[j], self.d[j], self.f[i], self.size[i], self.d[i], self.percent)]

    def enough(self, i: int, j: np.ndarray, both) -> np.ndarray:
        return j[100 * both >= self.percent * (self.size[j] + self.size[i] - both)]

    def forest(self, linked) -> list[tuple[int, int]]:
        """Pairs (a, b) by ``linked(i, candidates)``, one for each time that two components become one."""
        out = []
        for i in range(len(self.d)):
            j = linked(i, self.met(i)) if self.last[i] > i + 1 else ()
            while len(j):
                out.append((int(min(self.d[i], self.d[j[0]])), int(max(self.d[i], self.d[j[0]]))))
                self.c[self.c == self.c[j[0]]] = self.c[i]
                j = j[self.c[j] != self.c[i]]
        return out


class _Sketches:
    """An upper bound on the intersection of a tile's sets.

    Bits that one set has and the other has not stand for different shingles
    that the other lacks.  Sketches of different lengths are folded to the shorter.
    """

    def __init__(self, tile: _Tile, sketches: list[bytes]):
        self.tile = tile
        raw = [np.frombuffer(sketches[k], np.uint64) for k in tile.order]
        self.words = np.array([len(x) for x in raw])
        self.held: dict[int, np.ndarray] = {}
        for w in np.unique(self.words).tolist():
            rows = np.zeros((len(raw), w), np.uint64)
            for k, x in enumerate(raw if w else ()):
                if w <= len(x) <= 4 * w:        # linked sets differ less in size
                    rows[k] = np.bitwise_or.reduce(x.reshape(-1, w), axis=0)
            self.held[w] = rows

    def __call__(self, i: int, j: np.ndarray) -> np.ndarray:
        if not self.words[i]:
            return j                            # nothing is known of this set
        found = []
        for w in np.unique(self.words[j]).tolist():
            on = j[self.words[j] == w]
            if not w:
                found.append(on)
                continue
            rows = self.held[min(w, int(self.words[i]))]
            x, y = rows[i], rows[on]
            mine = self.tile.size[i] - np.bitwise_count(x & ~y).sum(1, dtype=np.int64)
            theirs = self.tile.size[on] - np.bitwise_count(y & ~x).sum(1, dtype=np.int64)
            found.append(self.tile.enough(i, on, np.minimum(mine, theirs)))
        return np.sort(np.concatenate(found)) if found else j


def _sketched(tiles: DataFrame, sketches: DataFrame) -> DataFrame:
    return tiles.join(sketches, ["doc_id", "size"]).groupBy("run", "lo", "hi")


def _likely_links(tiles: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs (run, lo, hi, a, b) that would join components if all were links: a forest per tile."""
    def run(t):
        tile = _Tile(t, percent)
        pairs = tile.forest(_Sketches(tile, t.column("sketch").to_pylist()))
        return t.select(["run", "lo", "hi"]).take(pa.array([0] * len(pairs), pa.int64())).append_column(
            "a", pa.array([a for a, _ in pairs], pa.int64())).append_column("b", pa.array([b for _, b in pairs], pa.int64()))

    return _sketched(tiles, sketches).applyInArrow(run, "run long, lo int, hi int, a long, b long")


def _undecided(tiles: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """(doc_id, partners): members that sketches still connect with members of other components, once each."""
    def run(t):
        tile, found = _Tile(t, percent), []
        bound = _Sketches(tile, t.column("sketch").to_pylist())
        for i in range(t.num_rows):
            j = bound(i, tile.met(i)) if tile.last[i] > i + 1 else ()
            if len(j):
                found.append((int(tile.d[i]), np.unique(tile.d[j])))
        return pa.table({"doc_id": pa.array([d for d, _ in found], pa.int64()),
                         "partners": pa.array([x for _, x in found], pa.list_(pa.int64()))})

    return (_sketched(tiles, sketches).applyInArrow(run, "doc_id long, partners array<long>")
            .groupBy("doc_id").agg(F.array_distinct(F.flatten(F.collect_list("partners"))).alias("partners")))


def _settled(docs: DataFrame, undecided: DataFrame, links: DataFrame, parts: DataFrame, by_class, percent: int) -> DataFrame:
    """The components after all pairs of ``undecided`` that are in different ones have been verified.

    In turns: each looks at the next few partners of every document, leaves out
    those that have come into its component, and closes the links found; the
    number of partners a turn grows fourfold, so the turns are few.
    """
    most, done, step = undecided.agg(F.max(F.size("partners"))).first()[0] or 0, 0, TURN
    while done < most:
        pairs = undecided.select(F.col("doc_id").alias("a"), F.explode(F.slice("partners", done + 1, step)).alias("b"))
        part = parts.select(F.col("doc_id").alias("b"), F.col("component_id").alias("pb"))
        apart = (pairs.join(parts.select(F.col("doc_id").alias("a"), F.col("component_id").alias("pa")), "a", "left").join(part, "b", "left")
                 .where(F.coalesce("pa", "a") != F.coalesce("pb", "b")))
        found = pinned(verified(docs, pinned(by_class(apart.select("a", "b"))), percent))
        if not found.isEmpty():
            links = pinned(links.union(found))
            parts = pinned(connected(links))
        done, step = done + step, 4 * step
    return parts


def _partners(own: np.ndarray, size: np.ndarray, name: bytes, percent: int) -> np.ndarray:
    """For each document of a run, another one of a size that can be similar enough, by a hash."""
    order = np.argsort(size, kind="stable")
    by = size[order].astype(np.int64)
    low = np.searchsorted(by, -(-by * percent // 100), "left")
    high = np.searchsorted(by, by * 100 // percent, "right")
    turn = mixed(own[order].astype(np.uint64) + np.frombuffer(name, np.uint64)[0])
    out = np.empty(len(own), np.int64)
    out[order] = order[low + (turn % (high - low).astype(np.uint64)).astype(np.int64)]
    return out


def _flatten(batches):
    for batch in batches:
        for run, members, ids, sizes, flags in zip(*(batch.column(c).to_pylist() for c in range(5))):
            d = np.frombuffer(ids, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(d), run)), pa.array(np.full(len(d), members)), pa.array(d),
                 pa.array(np.frombuffer(sizes, np.uint32).astype(np.int32)),
                 pa.array(np.frombuffer(flags, np.uint8).astype(np.int32))], ["run", "members", "doc_id", "size", "flag"])


def _in_few(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in no more partitions than so many rows need: a task of a small frame leaves files at every exchange."""
    return df.coalesce(max(LEAST_TASKS, -(-rows // TASK_ROWS)))


def verified(docs: DataFrame, pairs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of a pinned frame whose texts are similar enough, exactly.

    Pairs meet at a home by their smaller id, PER_HOME pairs or so at each; an id
    with many partners has several homes.
    """
    spark = docs.sparkSession
    count = pairs.count()
    homes, pairs = max(1, count // PER_HOME), _in_few(pairs, count)
    partners = pairs.groupBy("a").agg(F.ceil(F.count("*") / PER_HOME).alias("own"))
    homed = pinned(pairs.join(partners, "a").select(
        "a", "b", F.pmod(F.xxhash64("a", F.pmod(F.xxhash64("b"), "own")), F.lit(homes)).alias("home")))
    homed = _in_few(homed, count)
    wanted = homed.select(F.col("a").alias("doc_id"), "home").union(homed.select("b", "home")).distinct()
    wanted = pinned(_in_few(wanted, 2 * count))
    n = wanted.count()
    if not n:
        return spark.createDataFrame([], "a long, b long")
    wanted = wanted.withColumnRenamed("home", "place")
    texts = id_and_text(docs).join(F.broadcast(wanted) if n <= BROADCAST_ROWS else wanted, "doc_id")

    def check(left, right):
        hashes = WordHashes()
        sets: dict[int, list[np.ndarray]] = {}
        for doc_id, text in zip(left.column("doc_id").to_pylist(), left.column("text").to_pylist()):
            sets.setdefault(doc_id, []).append(shingles(text, hashes))
        a, b = [], []
        for x, y in zip(right.column("a").to_pylist(), right.column("b").to_pylist()):
            if any(_similar(u, v, percent) for u in sets.get(x, ()) for v in sets.get(y, ())):
                a.append(x), b.append(y)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return texts.groupBy("place").cogroup(homed.groupBy("home")).applyInArrow(check, "a long, b long")


def _similar(u: np.ndarray, v: np.ndarray, percent: int) -> bool:
    if not len(u) or not len(v):
        return False
    both = len(np.intersect1d(u, v, assume_unique=True))
    return 100 * both >= percent * (len(u) + len(v) - both)


def connected(links: DataFrame) -> DataFrame:
    """(doc_id, component_id) of every end of a link (a, b); the component's smallest id.

    Large-star and small-star steps in turn, each a partially aggregated minimum
    and an equi-join, until the links are stars around the smallest ids.
    """
    count = links.count()
    links = _in_few(links, count)

    def ordered(df, x, y):
        return _in_few(df.select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).where("u != v").distinct(), count)

    def starred(df) -> bool:
        """Whether every document has one smaller neighbour at most, and none if it has a larger one."""
        ends = df.select(F.col("u").alias("x"), F.lit(1).alias("below"), F.lit(0).alias("above")).union(
            df.select("v", F.lit(0), F.lit(1)))
        sides = ends.groupBy("x").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
        return sides.where("below > 1 or (below > 0 and above > 0)").isEmpty()

    edges = pinned(ordered(links, "a", "b"))
    while not starred(edges):
        both = edges.union(edges.select("v", "u")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = ordered(both.join(least, "u").where("v > u"), "v", "m")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = pinned(_in_few(small.select("v", "m").union(small.select("u", "m")).toDF("u", "v").where("u != v").distinct(), count))
    root = edges.select(F.col("v").alias("doc_id")).distinct()
    return edges.select(F.col("u").alias("doc_id"), F.col("v").alias("component_id")).union(
        root.select("doc_id", F.col("doc_id").alias("component_id")))


def join(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    spark: SparkSession = docs.sparkSession
    total = id_and_text(docs).agg(F.sum(F.octet_length("text")).alias("size"), F.count("*").alias("n")).first()
    ranges = max(shuffle_partitions(spark), -(-(total["size"] or 0) // RANGE_BYTES))
    common = spark.sparkContext.broadcast(common_shingles(docs, total.n))       # at most COMMON numbers
    blocks = _blocks(docs, common, ranges, percent).repartitionById(ranges, "range")
    found = pinned(_meet(blocks, percent))
    sets = found.where("kind = 0").select(F.col("x").alias("doc_id"), F.col("y").alias("n_shingles"), F.col("ids").alias("fp"))
    full = sets.where("n_shingles > 0")
    classes = full.groupBy("fp").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("n"))
    copies = pinned(full.join(classes.where("n > 1"), "fp").where("doc_id != class_id").select("doc_id", "class_id").distinct())

    def by_class(pairs: DataFrame) -> DataFrame:
        """Pairs of different classes, each by its smallest id."""
        a = copies.toDF("a", "ca")
        b = copies.toDF("b", "cb")
        both = pairs.join(a, "a", "left").join(b, "b", "left").select(
            F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
        return both.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    first = pinned(by_class(found.where("kind = 1").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()))
    links = pinned(verified(docs, first, percent).union(copies.toDF("b", "a").select("a", "b")))
    parts = pinned(connected(links))
    runs = found.where("kind = 2")
    # unknown, an empty sketch, where rows that share an id hold different sets of one size
    sketches = found.where("kind = 0 and length(sizes) > 0").groupBy(F.col("x").alias("doc_id"), F.col("y").cast("int").alias("size")).agg(
        F.when(F.min("ids") == F.max("ids"), F.min("sizes")).otherwise(F.lit(b"")).alias("sketch"))
    likely = pinned(_likely_links(_open_tiles(runs, parts), sketches, percent))
    if not likely.isEmpty():
        links = pinned(links.union(verified(docs, pinned(by_class(likely.select("a", "b").distinct())), percent)))
        parts = pinned(connected(links))
        # a tile without a likely link before has none now: components only grow
        tiles = _open_tiles(runs, parts).join(likely.select("run", "lo", "hi").distinct(), ["run", "lo", "hi"], "left_semi")
        parts = _settled(docs, pinned(_undecided(tiles, sketches, percent)), links, parts, by_class, percent)
    ids = id_and_text(docs).select("doc_id").where("doc_id is null").select(
        "doc_id", F.lit(None).cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return (sets.select("doc_id", "n_shingles").join(parts, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")).union(ids))


def _by_text(docs: DataFrame) -> DataFrame:
    """(vertex, doc_id, hash): a vertex for every different text of an id; the id itself where it has one text only.

    Texts of an id with several get numbers of their own beyond the ids, so that one
    of them may go without the others.
    """
    rows = id_and_text(docs).where("doc_id is not null").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("hash"))
    texts = rows.groupBy("doc_id").agg(F.min("hash").alias("lo"), F.max("hash").alias("hi"))
    single = texts.where("lo = hi").select(F.col("doc_id").alias("vertex"), "doc_id", F.col("lo").alias("hash"))
    several = pinned(rows.join(texts.where("lo != hi").select("doc_id"), "doc_id").distinct())
    ends = texts.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).first()
    if ends["hi"] is None:
        return single
    number = F.monotonically_increasing_id()
    beyond = F.lit(ends["hi"] + 1) + number if ends["hi"] < 2 ** 62 else F.lit(ends["lo"] - 1) - number
    return single.unionByName(several.select(beyond.alias("vertex"), "doc_id", "hash"))


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Of every group of linked documents one row, with all its columns: that of the smallest id.

    Rows are told apart by id and text: equal ones are one document, and texts that
    share an id are documents of their own, so a text that nothing is linked with
    stays whatever its id.  Rows without an id are kept.
    """
    at = {c.lower() for c in docs.columns}
    key, text = (next(n for n in (f"{base}{k}" for k in range(len(at) + 1)) if n not in at) for base in ("_kept", "_text_hash"))
    vertices = pinned(_by_text(docs))
    named = docs.where(F.col("doc_id").isNotNull()).withColumn(key, F.col("doc_id").cast("long")).withColumn(
        text, F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    moved = vertices.where("vertex != doc_id").select("vertex", F.col("doc_id").alias(key), F.col("hash").alias(text))
    if not moved.isEmpty():
        texts = named.select(key, text, "text").join(moved, [key, text], "left").withColumn(key, F.coalesce("vertex", key))
        joined = join(texts.select(F.col(key).alias("doc_id"), "text"), percent).select(
            F.col("doc_id").alias("vertex"), "component_id").distinct()
        first = vertices.join(joined, "vertex").groupBy("component_id").agg(F.min(F.struct("doc_id", "hash")).alias("first"))
        stay = first.select(F.col("first.doc_id").alias(key), F.col("first.hash").alias(text))
    else:
        kept = join(docs, percent).where("doc_id = component_id").select("component_id").distinct()
        stay = vertices.join(kept, F.col("vertex") == F.col("component_id"), "left_semi").select(
            F.col("doc_id").alias(key), F.col("hash").alias(text))
    one = (named.join(stay, [key, text], "left_semi").dropDuplicates([key, text])
           .select(*[F.col(f"`{c}`") for c in docs.columns]))
    return one.unionByName(docs.where(F.col("doc_id").isNull()))
