"""Census of files: schemas, headers and bad files in a number of jobs that does not grow with the files."""

import itertools
import os

from headway.plans import bikeshare as bk
from headway.plans import jobs
from headway.sources import census, gtfs
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

_number = itertools.count()


def jobs_of(spark, call):
    """(result, number of Spark jobs) of a call."""
    name = f"census-{next(_number)}"
    sc = spark.sparkContext
    sc.setJobGroup(name, name)
    try:
        out = call()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return out, len(sc.statusTracker().getJobIdsForGroup(name))


def _parquet(spark, folder, n, schema, first=0):
    """``n`` one-row Parquet files."""
    os.makedirs(folder, exist_ok=True)
    tmp = os.path.join(folder, f"_tmp{first}")
    spark.range(first, first + n, 1, n).selectExpr(*schema).write.parquet(tmp)
    parts = sorted(f for f in os.listdir(tmp) if f.endswith(".parquet"))
    for k, f in enumerate(parts):
        os.rename(os.path.join(tmp, f), os.path.join(folder, f"poll_{100000 + first + k}.parquet"))
        crc = os.path.join(tmp, f".{f}.crc")
        if os.path.exists(crc):
            os.remove(crc)


def test_parquet_census_jobs_do_not_grow(spark, scratch):
    counts = {}
    for n in (40, 160):
        folder = os.path.join(scratch, str(n))
        _parquet(spark, folder, n, ["id", "cast(id as string) as name"])
        (groups, bad), counts[n] = jobs_of(spark, lambda f=folder: census.parquet_census(spark, f, "poll_*.parquet"))
        assert [(s.names, len(p)) for s, p in groups] == [(["id", "name"], n)]
        assert bad.count() == 0
    assert counts[40] == counts[160]


def test_groups_by_clashing_types_and_bad_files(spark, scratch):
    folder = os.path.join(scratch, "day")
    _parquet(spark, folder, 30, ["id", "1 as extra"])
    _parquet(spark, folder, 30, ["id", "'x' as extra", "2.5 as more"], first=30)
    with open(os.path.join(folder, "poll_cut.parquet"), "wb") as f:
        f.write(b"PAR1" + b"x" * 100)
    with open(os.path.join(folder, "poll_nothing.parquet"), "wb") as f:
        f.write(b"?")
    spark.createDataFrame([], "id long, late date").coalesce(1).write.parquet(os.path.join(scratch, "none"))
    part = next(f for f in os.listdir(os.path.join(scratch, "none")) if f.endswith(".parquet"))
    os.rename(os.path.join(scratch, "none", part), os.path.join(folder, "poll_empty.parquet"))
    (groups, bad), n_jobs = jobs_of(spark, lambda: census.parquet_census(spark, folder, "poll_*.parquet"))
    assert sorted((tuple(s.names), len(p)) for s, p in groups) == [(("id", "extra"), 30), (("id", "extra", "more", "late"), 31)]
    assert sorted(os.path.basename(r.path) for r in bad.collect()) == ["poll_cut.parquet", "poll_nothing.parquet"]
    assert n_jobs < 40
    declared = StructType([StructField("id", LongType()), StructField("note", StringType())])
    rows = jobs.read_polls(spark, groups, declared)
    # declared columns are there, a column of differing types is text, files lacking a column have nulls
    assert {f.name: f.dataType.simpleString() for f in rows.schema.fields} == {
        "id": "bigint", "note": "string", "extra": "string", "more": "decimal(2,1)", "late": "date", "file_path": "string"}
    assert sorted((r.id, r.extra) for r in rows.collect()) == [(k, "1" if k < 30 else "x") for k in range(60)]


def test_declared_types_widen_the_files(spark, scratch):
    folder = os.path.join(scratch, "day")
    _parquet(spark, folder, 3, ["cast(id as int) as id"])
    groups, _ = census.parquet_census(spark, folder, "poll_*.parquet")
    rows = jobs.read_polls(spark, groups, StructType([StructField("id", DoubleType())]))
    assert sorted(r.id for r in rows.collect()) == [0.0, 1.0, 2.0]


def test_empty_folder_and_no_paths(spark, scratch):
    os.makedirs(os.path.join(scratch, "none"))
    groups, bad = census.parquet_census(spark, os.path.join(scratch, "none"))
    assert groups == [] and bad.count() == 0
    assert census.census_of(spark, []) == ([], [])
    assert census.header_census(spark, []) == ({}, [])


def _csv(folder, name, header, rows):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(",".join(header) + "\n" if header else "")
        f.writelines(",".join(map(str, r)) + "\n" for r in rows)
    return path


def test_header_census_jobs_do_not_grow(spark, scratch):
    counts = {}
    for n in (40, 1000):
        folder = os.path.join(scratch, str(n))
        paths = [_csv(folder, f"f {k}.csv", ["a", "b"] if k % 2 else ["b", " a", '"x,y"'], [(1, 2)]) for k in range(n)]
        (groups, missing), counts[n] = jobs_of(spark, lambda p=paths: census.header_census(spark, p))
        assert {h: len(p) for h, p in groups.items()} == {("a", "b"): n // 2, ("b", "a", "x,y"): n // 2} and not missing
    assert counts[40] == counts[1000]


def test_header_census_reads_first_lines_only(spark, scratch):
    big = _csv(scratch, "big.csv", ["a", "b"], [(k, "y" * 50) for k in range(200_000)])
    empty, gone = _csv(scratch, "empty.csv", [], []), os.path.join(scratch, "gone.csv")
    groups, missing = census.header_census(spark, [big, gone, empty])
    assert groups == {("a", "b"): [big]} and missing == [gone, empty]


def test_header_census_sends_no_rows_through_python(spark, scratch, monkeypatch):
    """A worker that stops after a file's first row was still sent the whole file, a row a batch."""
    def fails(*_, **__):
        raise AssertionError("rows of the files go through Python")

    paths = [_csv(scratch, f"{k}.csv", ["a", "b"][:k], [(1, "x")] * 10 * k) for k in (1, 2)]
    for name in ("mapInArrow", "mapInPandas"):
        monkeypatch.setattr(type(spark.range(1)), name, fails)
    assert census.header_census(spark, paths) == ({("a",): paths[:1], ("a", "b"): paths[1:]}, [])


def test_trip_files_by_header(spark, scratch):
    names = [*bk.REQUIRED_COLUMNS]
    row = ["A", "x", 45.0, -73.0, "B", "y", 45.5, -73.5, 1000, 61000.0]
    one = _csv(scratch, "one.csv", names, [row])
    two = _csv(scratch, "two.csv", [n.upper() for n in names[::-1]], [row[::-1]] * 2)
    bad = _csv(scratch, "bad.csv", names[1:], [row[1:]])
    gone = os.path.join(scratch, "gone.csv")
    trips, skipped = gtfs.read_trip_csvs(spark, [bad, one, gone, two])
    assert skipped == [bad, gone]
    assert {tuple(r) for r in trips.collect()} == {tuple(row)} and trips.count() == 3
