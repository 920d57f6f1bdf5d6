"""Transit and bike-share inputs derived from the driver's tables.

The test tables hold no transit data, so these frames reshape them (the
``fx_*`` views of FIXTURES.md part B).  Each is a plain DataFrame plan over the
parquet scans: its size grows with the tables, nothing is collected.
Service day under test: Friday 2023-12-01 in America/Montreal, local midnight
1701406800.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import sized_partitions

SERVICE_DAY = dt.date(2023, 12, 1)
SERVICE_TZ = "America/Montreal"
LOCAL_MIDNIGHT = 1701406800
CDN = "cdn.example.com"
CDN_ORIGIN = "https://cdn.example.com"
HIGH_WATER_MARK = 1710000000000

WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _grouped(df: DataFrame, *keys: str):
    """``groupBy(keys)`` after clustering by the keys.

    The fixture keys identify lineitem rows, so a map-side partial aggregate
    would not shrink anything; clustering first keeps the one exchange and runs
    the aggregation in parallel after it, however few splits the scan has.  A large
    input has a fixed number of partitions: joined again at run time, their groups
    would fill a task's memory.
    """
    n = sized_partitions(df.sparkSession)
    return (df.repartition(n, *keys) if n else df.repartition(*keys)).groupBy(*keys)


def _clock_text(sec: F.Column) -> F.Column:
    hh = F.lpad(F.floor(sec / 3600).cast("bigint").cast("string"), 2, "0")
    mm = F.lpad((F.floor(sec / 60).cast("bigint") % 60).cast("string"), 2, "0")
    ss = F.lpad((sec % 60).cast("string"), 2, "0")
    return F.concat_ws(":", hh, mm, ss)


def service_id() -> F.Column:
    return F.concat_ws("/", "o_orderpriority", F.col("o_custkey").cast("string"))


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One service per customer and priority; its span and weekdays follow from the customer key."""
    cust = F.col("o_custkey")
    start = F.date_add(F.lit(dt.date(2023, 11, 1)), (cust % 40).cast("int"))
    end = F.date_add(start, (15 + cust % 30).cast("int"))
    return (table(spark, sf_dir, "orders").select("o_orderpriority", "o_custkey").distinct()
            .select(service_id().alias("service_id"), F.date_format(start, "yyyyMMdd").alias("start_date"),
                    F.date_format(end, "yyyyMMdd").alias("end_date"),
                    *[F.when((cust + i) % 3 != 0, 1).otherwise(0).alias(w) for i, w in enumerate(WEEKDAYS)]))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % 97
    cust = F.col("o_custkey")
    direction = (F.when(cust % 5 == 0, "E").when(cust % 5 == 1, "O").when(cust % 5 == 2, "S")
                 .when(cust % 5 == 3, "N").otherwise("X"))
    return o.select(
        F.col("o_orderkey").alias("trip_id"),
        service_id().alias("service_id"),
        k.alias("route_id"),
        F.concat(F.lit("T"), k.cast("string"), F.lit("-"), direction).alias("trip_headsign"),
        (cust % 2).alias("direction_id"),
        F.concat(F.lit("S"), k.cast("string"), F.lit("_"), (cust % 3).cast("string")).alias("shape_id"),
        (cust % 3).alias("wheelchair_accessible"),
    )


def stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    s = (_grouped(li, "l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("stop_id"))
         .select(F.col("l_orderkey").alias("trip_id"),
                 F.col("l_linenumber").cast("bigint").alias("stop_sequence"), "stop_id"))
    sec = ((4 + F.col("trip_id") % 22) * 3600 + F.col("stop_sequence") * 420
           + (F.col("trip_id") * 7) % 60)
    clock = _clock_text(sec)
    return s.select("trip_id", clock.alias("arrival_time"), clock.alias("departure_time"),
                    "stop_id", "stop_sequence")


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.where(F.col("p_partkey") % 10 != 0).select(
        F.col("p_partkey").alias("stop_id"),
        F.col("p_name").alias("stop_name"),
        ((4540 + F.col("p_size")) / 100).alias("stop_lat"),
        ((-7360 - F.col("p_size")) / 100).alias("stop_lon"),
        (F.col("p_size") % 3).alias("wheelchair_boarding"),
    )


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey") % 97
    return (table(spark, sf_dir, "orders").where(k < 90)
            .select(k.alias("route_id")).distinct()
            .select("route_id", F.concat(F.lit("Line "), F.col("route_id").cast("string"))
                    .alias("route_long_name")))


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle-position polls as landed: numeric fields as text, ``poll_day`` 0/1.

    Every position is polled on the service day; a fifth of them are polled
    again the next day (same trip, +86 400 s), which the 7 200 s rule removes.
    """
    li = table(spark, sf_dir, "lineitem")

    def min_is(col: str, value: str) -> F.Column:
        # min(col) = value, as boolean aggregates (hash-aggregatable; nulls ignored alike)
        return F.every(F.col(col) >= value) & F.some(F.col(col) == value)

    p = (_grouped(li, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
         .agg(min_is("l_returnflag", "N").alias("rf_n"), min_is("l_linestatus", "O").alias("ls_o"))
         .select(F.col("l_orderkey").alias("trip_id"),
                 F.col("l_linenumber").cast("bigint").alias("seq"),
                 ((F.col("l_partkey") * 1000 + F.col("l_suppkey")) % 2000000000).alias("id"),   # an INT at any scale
                 "l_partkey", "l_suppkey", "rf_n", "ls_o"))
    vts = (F.lit(LOCAL_MIDNIGHT) + (4 + F.col("trip_id") % 22) * 3600 + F.col("seq") * 420
           + (F.col("trip_id") * 7) % 60 + (F.col("l_partkey") * 37 + F.col("l_suppkey") * 101) % 2700
           - 900)
    # one scan: each row is emitted for day 0, and again for day 1 when polled twice
    days = F.when(F.col("l_suppkey") % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    r = p.withColumn("vts", vts).withColumn("poll_day", F.explode(days))
    shifted = F.col("vts") + F.col("poll_day") * 86400
    return r.select(
        "poll_day",
        F.col("id").cast("string").alias("id"),
        (shifted + 11).alias("timefetch"),
        F.col("trip_id").cast("string").alias("vehicle_trip_tripId"),
        (F.col("trip_id") % 97).cast("string").alias("vehicle_trip_routeId"),
        F.floor(F.col("trip_id") / 3).cast("bigint").cast("string").alias("vehicle_vehicle_id"),
        shifted.cast("string").alias("vehicle_timestamp"),
        F.when(F.col("rf_n"), "IN_TRANSIT_TO").otherwise("STOPPED_AT").alias("vehicle_currentStatus"),
        F.col("seq").alias("vehicle_currentStopSequence"),
        F.when(F.col("ls_o"), "FULL").otherwise("MANY_SEATS_AVAILABLE").alias("vehicle_occupancyStatus"),
    )


def positions_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``positions`` keyed by the service date the poll belongs to (a date-partitioned table)."""
    return (positions(spark, sf_dir)
            .withColumn("service_date", F.date_add(F.lit(SERVICE_DAY), F.col("poll_day")))
            .drop("poll_day"))


def poll_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Service dates of the polls: of the scan's rows, without building the polls."""
    late = F.when(F.col("l_suppkey") % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (table(spark, sf_dir, "lineitem").select(F.explode(late).alias("poll_day")).distinct()
            .select(F.date_add(F.lit(SERVICE_DAY), F.col("poll_day")).alias("service_date")))


def bike_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Historical bike trips shaped like the yearly CSV (upper-case header, fractional end)."""
    li = table(spark, sf_dir, "lineitem")
    t = (_grouped(li, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
         .agg(F.max("l_quantity").alias("qty"))
         .withColumn("a", F.col("l_suppkey"))
         # every supplier is a station; keys run from 0
         .withColumn("b", (F.col("l_partkey") * 7 + F.col("l_orderkey"))
                     % table(spark, sf_dir, "supplier").agg(F.count(F.lit(1))).scalar()))
    nation = table(spark, sf_dir, "nation")
    station = (table(spark, sf_dir, "supplier")
               .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
               .select("s_suppkey", "s_name", "s_nationkey", "n_name"))

    def role(prefix: str, key: str) -> DataFrame:
        return station.select(
            F.col("s_suppkey").alias(key),
            F.col("s_name").alias(f"{prefix}STATIONNAME"),
            F.col("n_name").alias(f"{prefix}STATIONARRONDISSEMENT"),
            ((4540 + F.col("s_nationkey")) / 100).alias(f"{prefix}STATIONLATITUDE"),
            ((-7350 - F.col("s_nationkey")) / 100).alias(f"{prefix}STATIONLONGITUDE"))

    start = (F.lit(1709200000000) + (F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729
                                     + F.col("l_partkey") * 31) % 2592000 * 1000)
    j = t.join(role("START", "a"), "a").join(role("END", "b"), "b")
    return j.select(
        "STARTSTATIONNAME", "STARTSTATIONARRONDISSEMENT", "STARTSTATIONLATITUDE", "STARTSTATIONLONGITUDE",
        "ENDSTATIONNAME", "ENDSTATIONARRONDISSEMENT", "ENDSTATIONLATITUDE", "ENDSTATIONLONGITUDE",
        start.alias("STARTTIMEMS"),
        (start.cast("double") + F.col("qty") * 60000).alias("ENDTIMEMS"),
    )


def _rides_url(joint: str) -> F.Column:
    return F.concat(F.lit("https://cdn.example.com/rides/"), F.col("page_id").cast("string"), F.lit(f".csv.gz?part=1{joint}of=2"))


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every web page as a catalogue page: its own text, then blocks of rides.

    A block with a nested box and an escaped in-CDN address, a block that is
    commented out, a foreign one, one without a link, and a footer link.
    """
    pid = F.col("page_id")

    def heading(year: F.Column) -> list[F.Column]:
        return [F.lit('<h3 class="document-title title-4"> '), year.cast("string"), F.lit(" </h3>")]

    html = F.concat(
        F.coalesce(F.col("html"), F.lit("")),
        F.lit("<section><div id='first' class=\"shade document-row\"><div class=\"badge\"><div>season</div></div>"),
        *heading(2010 + pid % 20),
        F.lit("<a name=\"top\">rides</a><a rel=\"archive\" href='"), _rides_url("&amp;"), F.lit("'>rides</a></div>"),
        F.lit("<!-- <div class=\"document-row\"> -->"),
        F.lit("<div class='document-row'>"), *heading(2010 + pid % 7),
        F.lit('<a href="https://other.example.org/rides/'), pid.cast("string"), F.lit('">mirror</a></div>'),
        F.lit('<div class="document-row">'), *heading(2010 + pid % 13), F.lit("<p>to come</p></div></section>"),
        F.lit('<footer><a href="https://cdn.example.com/terms/'), pid.cast("string"), F.lit('">terms</a></footer>'))
    return table(spark, sf_dir, "pages").select("page_id", html.alias("html"))


def page_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue link and year of every page."""
    pid = F.col("page_id")
    return table(spark, sf_dir, "pages").select(
        "page_id", _rides_url("&").alias("url"), (2010 + pid % 20).cast("int").alias("year"))


def loaded_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger: a third of the links were loaded before."""
    return page_urls(spark, sf_dir).where(F.col("page_id") % 3 == 0).select("url", "year")


def station_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").cast("string").alias("station_id"),
                    (F.col("event_id") % 40).alias("num_bikes_available"),
                    (F.col("event_id") % 2).alias("is_renting"),
                    F.col("event_id").alias("last_reported"))


def stored_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations already in the store: suppliers with an even key, arrondissement changed since."""
    s = table(spark, sf_dir, "supplier").where(F.col("s_suppkey") % 2 == 0)
    n = table(spark, sf_dir, "nation")
    return (s.join(n, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(F.col("s_name").alias("name"),
                    F.concat(F.lit("stored "), F.col("n_name")).alias("arrondissement"),
                    ((4540 + F.col("s_nationkey")) / 100).alias("latitude"),
                    ((-7350 - F.col("s_nationkey")) / 100).alias("longitude")))


def source_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freshness ledger rows: HTTP ``Last-Modified`` of each source and the stored one.

    Four cases by key: never stored, stored older, stored equal, stored newer.
    """
    o = table(spark, sf_dir, "orders")
    fmt = "EEE, dd MMM yyyy HH:mm:ss 'GMT'"
    incoming = F.col("o_orderdate")
    case = F.col("o_orderkey") % 4
    stored = (F.when(case == 1, incoming - F.expr("INTERVAL 1 DAY"))
              .when(case == 2, incoming)
              .when(case == 3, incoming + F.expr("INTERVAL 1 DAY")))
    return o.select(F.col("o_orderkey").alias("source_id"),
                    F.date_format(incoming, fmt).alias("last_modified"),
                    F.date_format(stored, fmt).alias("stored_last_modified"))
