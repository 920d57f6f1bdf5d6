"""STR1, STR2: file-source streams with availableNow triggers and checkpoints."""

import os

from pyspark.sql.types import LongType, StringType, StructField, StructType

from headway.streaming import landing


def test_positions_landing_stream(spark, scratch):
    land = os.path.join(scratch, "landing")
    os.makedirs(land)
    schema = StructType([StructField("id", StringType()), StructField("timefetch", LongType())])
    spark.createDataFrame([("a",)], "id string").coalesce(1).write.parquet(os.path.join(scratch, "p1"))
    part = [f for f in os.listdir(os.path.join(scratch, "p1")) if f.endswith(".parquet")][0]
    os.rename(os.path.join(scratch, "p1", part), os.path.join(land, "vp_1701442900.parquet"))
    table, ckpt = os.path.join(scratch, "table"), os.path.join(scratch, "ckpt")
    landing.positions_landing_stream(spark, land, table, ckpt, schema).awaitTermination()
    rows = spark.read.parquet(table).collect()
    assert [(r.id, r.timefetch, str(r.service_date)) for r in rows] == [("a", 1701442900, "2023-12-01")]
    # a second run sees no new file: nothing is added
    landing.positions_landing_stream(spark, land, table, ckpt, schema).awaitTermination()
    assert spark.read.parquet(table).count() == 1


def _poll(spark, folder, name, rows, schema):
    tmp = os.path.join(folder, f"_{name}")
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(tmp)
    part = next(f for f in os.listdir(tmp) if f.endswith(".parquet"))
    land = os.path.join(folder, "landing")
    os.makedirs(land, exist_ok=True)
    os.rename(os.path.join(tmp, part), os.path.join(land, f"{name}.parquet"))


POLL = StructType([StructField("id", StringType()), StructField("timefetch", LongType())])


def test_stream_keeps_columns_that_no_schema_names(spark, scratch):
    _poll(spark, scratch, "vp_1701442900", [("a", "red")], "id string, colour string")
    _poll(spark, scratch, "vp_1701442960", [("b", 7, 1701442955)], "id string, doors int, timefetch int")
    table = os.path.join(scratch, "table")
    landing.positions_landing_stream(spark, os.path.join(scratch, "landing"), table, os.path.join(scratch, "ckpt"), POLL).awaitTermination()
    rows = {r.id: r for r in spark.read.option("mergeSchema", True).parquet(table).collect()}
    assert (rows["a"].colour, rows["a"].doors, rows["a"].timefetch) == ("red", None, 1701442900)
    assert (rows["b"].colour, rows["b"].doors, rows["b"].timefetch) == (None, 7, 1701442955)


def test_stream_goes_on_after_a_corrupt_file(spark, scratch):
    _poll(spark, scratch, "vp_1701442900", [("a",)], "id string")
    with open(os.path.join(scratch, "landing", "vp_1701442930.parquet"), "wb") as f:
        f.write(b"PAR1 and then nothing of use")
    with open(os.path.join(scratch, "landing", "vp_1701442940.parquet"), "wb") as f:
        f.write(b"?")
    table, ckpt = os.path.join(scratch, "table"), os.path.join(scratch, "ckpt")
    landing.positions_landing_stream(spark, os.path.join(scratch, "landing"), table, ckpt, POLL).awaitTermination()
    _poll(spark, scratch, "vp_1701442960", [("b",)], "id string")
    landing.positions_landing_stream(spark, os.path.join(scratch, "landing"), table, ckpt, POLL).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(table).collect()) == ["a", "b"]
    rejects = spark.read.parquet(table + "_rejects").collect()
    assert sorted(os.path.basename(r.path) for r in rejects) == ["vp_1701442930.parquet", "vp_1701442940.parquet"]


def test_a_replayed_batch_lands_once(spark, scratch):
    _poll(spark, scratch, "vp_1701442900", [("a",), ("b",)], "id string")
    table, ckpt = os.path.join(scratch, "table"), os.path.join(scratch, "ckpt")
    landing.positions_landing_stream(spark, os.path.join(scratch, "landing"), table, ckpt, POLL).awaitTermination()
    for name in ("0", ".0.crc"):          # the batch was written, its commit is lost
        os.remove(os.path.join(ckpt, "commits", name))
    landing.positions_landing_stream(spark, os.path.join(scratch, "landing"), table, ckpt, POLL).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(table).collect()) == ["a", "b"]


COLUMNS = ["STARTSTATIONNAME", "STARTSTATIONARRONDISSEMENT", "STARTSTATIONLATITUDE", "STARTSTATIONLONGITUDE",
           "ENDSTATIONNAME", "ENDSTATIONARRONDISSEMENT", "ENDSTATIONLATITUDE", "ENDSTATIONLONGITUDE", "STARTTIMEMS", "ENDTIMEMS"]


def _ride(start, end, at, minutes):
    return [start, f"{start} side", 45.4, -73.6, end, f"{end} side", 45.6, -73.4, at, float(at + minutes * 60000)]


def _write(path, columns, rows):
    with open(path, "w") as f:
        f.write(",".join(columns) + "\n")
        f.writelines(",".join(map(str, r)) + "\n" for r in rows)


def test_bike_trips_stream(spark, scratch):
    src = os.path.join(scratch, "csv")
    os.makedirs(src)
    trips, stations, ckpt = (os.path.join(scratch, x) for x in ("trips", "stations", "ckpt"))
    _write(os.path.join(src, "june.csv"), COLUMNS, [_ride("Quay", "Park", 1686000000000, 4), _ride("Park", "Tower", 1686000900000, 11)])
    _write(os.path.join(src, "half.csv"), COLUMNS[:4], [["Lost", "x", 1.0, 2.0]])
    landing.bike_trips_stream(spark, src, trips, stations, ckpt).awaitTermination()
    assert sorted(r.durationMs for r in spark.read.parquet(trips).collect()) == [240000.0, 660000.0]
    assert sorted(r.name for r in spark.read.parquet(stations).collect()) == ["Park", "Quay", "Tower"]
    # a file without the required columns is put aside
    assert [os.path.basename(r.path) for r in spark.read.parquet(trips + "_rejects").collect()] == ["half.csv"]
    # a file with its columns in another order is read by its own header
    back = COLUMNS[::-1]
    _write(os.path.join(src, "july.csv"), back, [_ride("Quay", "Bridge", 1688700000000, 2)[::-1]])
    landing.bike_trips_stream(spark, src, trips, stations, ckpt).awaitTermination()
    assert spark.read.parquet(trips).count() == 3
    assert sorted(r.name for r in spark.read.parquet(stations).collect()) == ["Bridge", "Park", "Quay", "Tower"]
