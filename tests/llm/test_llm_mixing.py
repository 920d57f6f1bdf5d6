"""Operator 13 against a plain emulation: targets, words of sources, bounds, reruns, odd rows."""

import collections
import hashlib
import random
import re
from fractions import Fraction

import pytest
from pyspark.sql import types as T

from headway.llm import mixing

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()),
    # names that the operator's own columns have, too
    T.StructField("size", T.StringType()), T.StructField("target", T.StringType()), T.StructField("item", T.StringType()),
    T.StructField("i", T.StringType()), T.StructField("_slice", T.StringType()), T.StructField("_n", T.StringType())])


def odd_rows(seed=3, n=900):
    rng = random.Random(seed)
    sources = ["a", "B", "é", "𝒳", None, "", "c", "d", "e"]
    rows = []
    for i in range(n):
        k = 0 if rng.random() < 0.35 else rng.randrange(9)
        words = 0 if rng.random() < 0.05 else int(rng.lognormvariate(3, 1)) + 1
        rows.append((i, rng.choice([None, "", " \t\n"]) if not words else " ".join(["wórd"] * words), sources[k]))
    rows += [(None, "no id here", "a"), (None, None, None), (5000, "x " * 30_000, "c")] + [rows[1]] * 40 + [(n, "\x1c \x85 b", "tiny")]
    rng.shuffle(rows)
    return [(*r, "s", "t", "i", "i", "s", "n") for r in rows]


def exact_targets(sizes):
    """By rounds of shared excess, in fractions."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(order)}
    capped = set()
    while True:
        rest = Fraction(3, 2) * sum(sizes.values()) - sum(2 * sizes[s] for s in capped)
        free = [s for s in order if s not in capped]
        part = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if part[s] > 2 * sizes[s]}
        if not above:
            return {**{s: Fraction(2 * sizes[s]) for s in capped}, **part}
        capped |= above


def plain_mix(rows, run):
    words = [(s, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), i) for i, t, s, *_ in rows]
    sizes = collections.Counter()
    for s, n, _ in words:
        sizes[s] += n
    target, out = exact_targets(sizes), []
    for s in sizes:
        own = sorted(((n, i) for x, n, i in words if x == s), key=lambda x: (-x[0], x[1] is not None, x[1] or 0))
        goal = float(target[s])
        whole = int(goal // sizes[s]) if sizes[s] else 0
        fraction = (goal - whole * sizes[s]) / sizes[s] if sizes[s] else 0.0
        items = [(k, n, i, fraction * n) for k, (n, i) in enumerate(own) if n and fraction > 0]
        more = [(n, i, 0) for n, i in own if not (n and fraction > 0)]
        level = 0
        while len(items) > 1:
            kept = []
            for first in range(0, len(items), run):
                a = items[first]
                for b in items[first + 1:first + run]:
                    up, down = min(a[1] - a[3], b[3]), min(a[3], b[1] - b[3])
                    key = f"{mixing.SEED}:{'1' if s is None else '0' + s}:{level}:{a[0]}:{b[0]}"
                    if int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / 2 ** 52 * (up + down) < down:
                        if a[1] - a[3] <= b[3]:
                            more.append((a[1], a[2], 1))
                            a = (*b[:3], b[3] - up)
                        else:
                            more.append((b[1], b[2], 0))
                            a = (*a[:3], a[3] + up)
                    elif a[3] <= b[1] - b[3]:
                        more.append((a[1], a[2], 0))
                        a = (*b[:3], b[3] + down)
                    else:
                        more.append((b[1], b[2], 1))
                        a = (*a[:3], a[3] - down)
                kept.append((first // run, *a[1:]))
            items, level = kept, level + 1
        more += [(n, i, int(2 * mass >= n)) for _, n, i, mass in items]
        out += [(i, n, sizes[s], round(goal, 6), (whole + m) * n) for n, i, m in more]
    return collections.Counter(out)


def got(df):
    assert df.columns == ["doc_id", "size", "source_size", "target", "taken"]
    return collections.Counter((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in df.collect())


@pytest.mark.parametrize("run", [64, 3])
def test_mix_equals_plain_python(spark, run):
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    first = got(mixing.mix(df.repartition(5), run))
    assert first == plain_mix(rows, run)
    if run == 3:
        assert first == got(mixing.mix(df.repartition(2, "text"), run))       # reruns agree


def test_sources_come_to_their_targets(spark):
    rows = odd_rows(8, 3000)
    by = collections.defaultdict(list)
    source = {r[0]: r[2] for r in rows if r[0] is not None}
    for r in mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect():
        assert 0 <= r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        if r.doc_id is not None:
            by[source[r.doc_id]].append(r)
    assert any(r[0].target == 2 * r[0].source_size for r in by.values())       # one source is at its bound
    for rs in by.values():
        assert abs(sum(r.taken for r in rs) - rs[0].target) <= max(r.size for r in rs) / 2 + 10


def test_no_rows_and_no_words(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).collect() == []
    blank = [(i, [None, "", " "][i % 3], "a", *"stiisn") for i in range(9)]
    assert got(mixing.mix(spark.createDataFrame(blank, SCHEMA))) == collections.Counter((i, 0, 0, 0.0, 0) for i in range(9))


def test_plan_has_no_python(spark):
    plan = mixing.mix(spark.createDataFrame(odd_rows(n=100), SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
