"""Range-sliced neighbours / group maxima / row numbers vs a plain global sort."""

import random

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from headway.operators import ordered as od

ORDER = ["g", "k"]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "g long, k long, v long")


def _expected(rows):
    pdf = pd.DataFrame(rows, columns=["g", "k", "v"]).sort_values(ORDER, kind="mergesort").reset_index(drop=True)
    pdf["prev_v"] = pdf["v"].shift(1)
    pdf["prev_g"] = pdf["g"].shift(1)
    pdf["next_v"] = pdf["v"].shift(-1)
    pdf["gmax"] = pdf.groupby("g")["k"].transform("max")
    pdf["idx"] = range(len(pdf))
    return pdf


def _check(spark, rows, slices):
    base = od.slice_by_order(_frame(spark, rows), ORDER, num_slices=slices)
    out = od.with_neighbour(base, ORDER, ["g", "v"], "prev", "p")
    out = od.with_neighbour(out, ORDER, ["v"], "next", "n")
    out = od.with_group_max(out, ORDER, ["g"], "k", "gmax")
    out = od.global_row_number(out, ORDER, "idx")
    got = sorted((r.g, r.k, r.p.v if r.p else None, r.p.g if r.p else None, r.n.v if r.n else None,
                  r.gmax, r.idx) for r in out.collect())
    exp = _expected(rows)
    want = sorted((int(r.g), int(r.k), None if pd.isna(r.prev_v) else int(r.prev_v),
                   None if pd.isna(r.prev_g) else int(r.prev_g), None if pd.isna(r.next_v) else int(r.next_v),
                   int(r.gmax), int(r.idx)) for r in exp.itertuples())
    assert got == want


def test_hot_group_spans_many_slices(spark):
    # one group holds most rows: it must be split across slices and still be right
    rows = [(7, k, k * 10) for k in range(300)] + [(g, k, g + k) for g in range(5) for k in range(3)]
    _check(spark, rows, slices=12)


def test_more_slices_than_rows(spark):
    _check(spark, [(1, 1, 5), (1, 2, 6), (2, 1, 7)], slices=16)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 10_000)), min_size=1, max_size=120, unique=True),
       st.integers(1, 9))
def test_matches_global_shift(spark, keys, slices):
    rng = random.Random(len(keys))
    rows = [(g, k, rng.randint(-50, 50)) for g, k in keys]
    _check(spark, rows, slices)


def test_first_last_keep(spark):
    df = spark.createDataFrame(
        [(1, 1, None, 10), (1, 2, 5, 20), (1, 3, 9, 30), (2, 1, 4000, 40)], "g long, o long, x long, p long")
    from pyspark.sql import functions as F
    out = {r.g: r for r in od.first_last_keep(df, ["g"], ["o"], "x", F.abs(F.col("x")) <= 1800, ["p"]).collect()}
    assert out[1].first_x is None and out[1].last_x == 9 and out[1].kept.p == 20
    assert out[2].kept is None


def test_bad_direction(spark):
    with pytest.raises(ValueError):
        od.with_neighbour(_frame(spark, [(1, 1, 1)]), ORDER, ["v"], "up", "x")


def test_slices_fill_all_tasks(spark):
    """Slice k is task k: rows per task are even, with a group that holds a third of them."""
    rows = [(7, k, k) for k in range(1000)] + [(g, k, g) for g in range(100, 2100) for k in range(1)]
    base = od.slice_by_order(_frame(spark, rows), ORDER, num_slices=12)
    from pyspark.sql import functions as F
    sizes = [r.n for r in base.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 12 and max(sizes) <= 2 * len(rows) / 12


def test_no_stale_rows_and_nothing_cached(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (5, 9):        # another writer replaces the table behind the session's back
        _frame(spark, [(1, k, k) for k in range(n)]).write.mode("overwrite").parquet(path)
        spark.catalog.refreshByPath(path)
        base = od.slice_by_order(spark.read.parquet(path), ORDER, num_slices=3)
        assert od.with_neighbour(base, ORDER, ["v"], "prev", "p").count() == n
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_segmented_scan_and_group_ends_equal_whole_frame_windows(spark):
    """Against windows over the whole frame: a group over many slices, one-row slices, null groups and values."""
    rng = random.Random(4)
    rows = [(rng.choice([1, 2, 2, 2, 2, 3, None]), i, rng.choice([None, *range(50)])) for i in range(400)]
    df = spark.createDataFrame(rows, "g int, k int, v int")
    whole = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    biggest, firsts, lasts = {}, {}, {}
    for g, _, v in whole:
        biggest[g] = max((x for x in (biggest.get(g), v) if x is not None), default=None)
        firsts.setdefault(g, v)
        lasts[g] = v
    want = sorted((g, k, whole[i + 1][1] if i + 1 < len(whole) else None, biggest[g], firsts[g], lasts[g]) for i, (g, k, v) in
                  enumerate(whole) if g is not None)
    for slices in (1, 7, 60):
        sliced = od.slice_by_order(df, ["g", "k"], slices)
        out = od.segmented_scan(sliced, ["g", "k"], ["k"], "nxt", ["g"], "v", "most")
        out = od.with_group_ends(od.pin(out), ["g"], ["g", "k"], "v", "first_v", "last_v")
        got = sorted((r.g, r.k, r.nxt.k if r.nxt else None, r.most, r.first_v, r.last_v) for r in out.collect() if r.g is not None)
        assert got == want
        assert out.count() == len(rows)
