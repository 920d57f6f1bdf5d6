"""Bike share: historical trip loads (C10, C11), station dimension, catalogue checks.

The reference loads a yearly CSV in bounded batches into a document store.
Here a whole increment is one DataFrame: split-parallel CSV scan, one
high-water-mark filter (a scalar subquery, not a driver loop), trips appended
in one commit, then stations inserted if absent, then the ledger row.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Column layout of the 2022+ trip files (checked case-insensitively)
START_COLUMNS = ["startStationName", "startStationArrondissement", "startStationLatitude",
                 "startStationLongitude"]
END_COLUMNS = ["endStationName", "endStationArrondissement", "endStationLatitude",
               "endStationLongitude"]
TIME_COLUMNS = ["startTimeMs", "endTimeMs"]
REQUIRED_COLUMNS = START_COLUMNS + END_COLUMNS + TIME_COLUMNS
LOCATION_COLUMNS = ["name", "arrondissement", "latitude", "longitude"]
TRIP_COLUMNS = ["startStationName", "endStationName", "startTimeMs", "endTimeMs", "durationMs"]

# Year ranges of the known file layouts
FIRST_KNOWN_YEAR = 2014
FIRST_2022_LAYOUT_YEAR = 2022

# What marks a block and its year on the catalogue pages
BLOCK_CLASS = "document-row"
YEAR_CLASS = "document-title title-4"

# Comments and raw text, whose tags are no elements
NOT_MARKUP = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
_ATTRIBUTES = r"""[^"'>]*+(?:"[^"]*+"[^"'>]*+|'[^']*+'[^"'>]*+)*+"""
DIV_TAG = rf"(?i)<div\b{_ATTRIBUTES}>|</div\s*>"
ANCHOR_TAG = rf"(?i)<a\b{_ATTRIBUTES}>"
YEAR_ELEMENT = rf"(?is)<h3\b({_ATTRIBUTES})>(.*?)</h3\s*>"


# ---------------------------------------------------------------- columns

def has_required_columns(columns: Iterable[str], required: Sequence[str] = REQUIRED_COLUMNS) -> bool:
    """Every required name is present, compared case-insensitively."""
    present = {c.lower() for c in columns}
    return all(r.lower() in present for r in required)


def normalise_trip_columns(raw: DataFrame) -> DataFrame:
    """Map the file's header to the canonical names by lower-cased name.

    (The reference renames by position; for in-order files the result is the same,
    and a reordered file is not mislabelled.)
    """
    by_lower = {c.lower(): c for c in raw.columns}
    missing = [c for c in REQUIRED_COLUMNS if c.lower() not in by_lower]
    if missing:
        raise ValueError(f"missing trip columns: {missing}")
    return raw.select(*[F.col(f"`{by_lower[c.lower()]}`").alias(c) for c in REQUIRED_COLUMNS])


# ---------------------------------------------------------------- trips

def bike_trip_durations(trips: DataFrame) -> DataFrame:
    """the stored trip rows with ``durationMs = endTimeMs - startTimeMs``."""
    return trips.select("startStationName", "endStationName", "startTimeMs", "endTimeMs",
                        (F.col("endTimeMs") - F.col("startTimeMs")).alias("durationMs"))


def high_water_mark(stored_trips: DataFrame) -> Column:
    """Highest stored ``startTimeMs`` (null when nothing is stored) as a scalar subquery."""
    return stored_trips.agg(F.max("startTimeMs")).scalar()


def high_water_increment(new_trips: DataFrame, stored_trips: DataFrame | None = None,
                         mark: int | Column | None = None) -> DataFrame:
    """Keep rows strictly after the mark; with no mark every row is kept.

    The mark is taken once, before anything of this load is written, so rows of
    one file are never filtered by another file's maximum.
    """
    if mark is None and stored_trips is not None:
        mark = high_water_mark(stored_trips)
    if mark is None:
        return new_trips
    m = mark if isinstance(mark, Column) else F.lit(mark)
    return new_trips.where(m.isNull() | (F.col("startTimeMs") > m))


def mean_trip_duration(trips: DataFrame) -> DataFrame:
    """Mean duration and trip count per (start, end) station pair."""
    with_duration = trips if "durationMs" in trips.columns else bike_trip_durations(trips)
    return (with_duration.groupBy("startStationName", "endStationName")
            .agg(F.avg("durationMs").alias("mean_duration_ms"), F.count(F.lit(1)).alias("trip_count")))


# ---------------------------------------------------------------- stations (U3, A4, SNK5)

def station_locations(trips: DataFrame) -> DataFrame:
    """U3 + A4: start and end stations stacked in one pass, one row per name.

    Survivor: start role before end role, then earliest ``startTimeMs``, then
    arrondissement, latitude, longitude (partially aggregated: hot names are fine).

    The earliest time of each place and role comes first, as plain numbers that
    Spark aggregates by hash; comparing rows whole would sort every trip twice.
    What is left are the places of each name.
    """
    def role(cols: Sequence[str], rank: int) -> Column:
        return F.struct(*[F.col(c).alias(n) for c, n in zip(cols, LOCATION_COLUMNS)],
                        F.lit(rank).alias("role"), F.col("startTimeMs").alias("t"))

    stacked = trips.select(F.inline(F.array(role(START_COLUMNS, 0), role(END_COLUMNS, 1))))
    # a missing time is the earliest
    earliest = F.when(F.max(F.col("t").isNull()), F.lit(None)).otherwise(F.min("t"))
    places = stacked.groupBy(*LOCATION_COLUMNS, "role").agg(earliest.alias("t"))
    value = F.struct(*[F.col(c) for c in LOCATION_COLUMNS[1:]])
    ordering = F.struct("role", "t", *LOCATION_COLUMNS[1:])
    return (places.groupBy("name").agg(F.min_by(value, ordering).alias("v"))
            .select("name", "v.*"))


def stations_insert_if_absent(new_stations: DataFrame, existing: DataFrame) -> DataFrame:
    """SNK5 + J11: the station table after inserting unseen names; stored rows never change."""
    added = new_stations.join(existing.select("name"), "name", "left_anti")
    return existing.select(*LOCATION_COLUMNS).unionByName(added.select(*LOCATION_COLUMNS))


# ---------------------------------------------------------------- catalogue

def attribute(tag: Column, name: str) -> Column:
    """The value of a tag's attribute, in either quote or none, entities decoded; null if the tag has none."""
    found = F.regexp_extract(tag, rf"""(?is)\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
    return F.when(found != "", decoded_entities(F.regexp_replace(found, "^[\"']|[\"']$", "")))


def decoded_entities(text: Column) -> Column:
    """Character references as characters: the five named ones, and numbers in decimal or hexadecimal."""
    pattern = r"(?i)&(#x[0-9a-f]{1,6}|#[0-9]{1,7}|lt|gt|quot|apos|amp);"
    named = F.create_map(*[F.lit(x) for pair in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("amp", "&"))
                           for x in pair])

    def letter(ref: Column) -> Column:
        code = F.when(ref.rlike("^#[xX]"), F.conv(F.substring(ref, 3, 6), 16, 10)).when(
            ref.startswith("#"), F.substring(ref, 2, 7)).cast("int")
        valid = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        number = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise("\ufffd")
        return F.when(ref.startswith("#"), number).otherwise(named[F.lower(ref)])

    letters = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), letter)
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("t"), F.concat(letters, F.array(F.lit(""))).alias("l"))
    return F.when(text.contains("&"), F.array_join(F.transform(pairs, lambda x: F.concat(x["t"], x["l"])), "")).otherwise(text)


def _blocks(html: Column) -> Column:
    """The content of every block of a page, in order of their opening tags.

    One pass over the page's div tags with a running depth: a block ends at the
    closing tag of its own depth, so boxes nested in it (blocks too) belong to
    it and what follows it does not.  A block that is never closed ends with
    the page.
    """
    tags = F.regexp_extract_all(html, F.lit(DIV_TAG), F.lit(0))
    texts = F.slice(F.split(html, DIV_TAG, -1), F.lit(1), F.size(tags))
    state = "struct<at:int,depth:int,open:array<struct<start:int,depth:int>>,done:array<struct<start:int,stop:int>>>"
    none = F.from_json(F.lit('{"at":0,"depth":0,"open":[],"done":[]}'), state)

    def marks_block(tag: Column) -> Column:
        return F.coalesce(F.array_contains(F.split(F.trim(attribute(tag, "class")), r"\s+"), BLOCK_CLASS), F.lit(False))

    def step(s: Column, x: Column) -> Column:
        opens = ~x["tag"].startswith("</")
        before = s["at"] + F.char_length(x["text"])
        after = before + F.char_length(x["tag"])
        depth = F.when(opens, s["depth"] + 1).otherwise(F.greatest(s["depth"] - 1, F.lit(0)))
        last = F.get(s["open"], F.size(s["open"]) - 1)          # null if no block is open
        ends = ~opens & F.coalesce(last["depth"] == s["depth"], F.lit(False))
        begun = F.array(F.struct(after.alias("start"), depth.alias("depth")))
        return F.struct(
            after.alias("at"), depth.alias("depth"),
            F.when(opens & marks_block(x["tag"]), F.concat(s["open"], begun))
            .when(ends, F.slice(s["open"], F.lit(1), F.size(s["open"]) - 1)).otherwise(s["open"]).alias("open"),
            F.when(ends, F.concat(s["done"], F.array(F.struct(last["start"].alias("start"), before.alias("stop")))))
            .otherwise(s["done"]).alias("done"))

    def spans(s: Column) -> Column:
        unclosed = F.transform(s["open"], lambda o: F.struct(o["start"].alias("start"), F.char_length(html).alias("stop")))
        return F.sort_array(F.concat(s["done"], unclosed))

    found = F.aggregate(F.arrays_zip(texts.alias("text"), tags.alias("tag")), none, step, spans)
    return F.transform(found, lambda b: F.substring(html, b["start"] + 1, b["stop"] - b["start"]))


def catalogue_entries(pages: DataFrame) -> DataFrame:
    """F13 scan: every (page_id, position, year, url) block of the catalogue pages.

    A block is a ``div`` of the block's class, with all that lies within it.  Its
    year is the number in its first year heading, null if there is none; its link
    the first one within it that has an address, null if it has none.
    """
    clean = F.regexp_replace(F.col("html"), NOT_MARKUP, "")
    blocks = (pages.where(F.contains(F.col("html"), F.lit(BLOCK_CLASS)))
              .select("page_id", clean.alias("html"))
              .select("page_id", F.posexplode(_blocks(F.col("html"))).alias("pos", "block")))
    headings = F.transform(F.regexp_extract_all("block", F.lit(YEAR_ELEMENT), F.lit(0)), lambda h: F.struct(
        attribute(F.regexp_extract(h, rf"(?i)^<h3\b{_ATTRIBUTES}>", 0), "class").alias("class"),
        F.trim(F.regexp_replace(h, r"(?s)<[^>]*>", "")).alias("text")))
    year = F.filter(headings, lambda h: h["class"] == YEAR_CLASS)
    links = F.filter(F.transform(F.regexp_extract_all("block", F.lit(ANCHOR_TAG), F.lit(0)), lambda a: attribute(a, "href")),
                     lambda u: u.isNotNull())
    return blocks.select("page_id", "pos",
                         F.get(year, F.lit(0))["text"].try_cast("int").alias("year"),
                         F.get(links, F.lit(0)).alias("url"))


def catalogue_links(pages: DataFrame, cdn: str, low: int = 2014, top: int = 2099) -> DataFrame:
    """F13 + P12: {year: url} of in-CDN links with ``low <= year <= top``; the last block wins."""
    links = catalogue_entries(pages).where(F.col("url").contains(cdn) & F.col("year").between(low, top))
    return links.groupBy("year").agg(F.max_by("url", F.struct("page_id", "pos")).alias("url"))


def new_catalogue_entries(links: DataFrame, loaded_urls: DataFrame) -> DataFrame:
    """C9 + J10 + U4: catalogue links not loaded yet, as (year, url)."""
    return links.join(loaded_urls.select("url"), "url", "left_anti").select("year", "url")


def has_new_entries(entries: DataFrame) -> bool:
    """C9's ``process`` flag."""
    return not entries.isEmpty()


def year_layout(year: Column) -> Column:
    """File layout of a year: '2022' from 2022, '2014' for 2014-2021, null before."""
    return (F.when(year >= FIRST_2022_LAYOUT_YEAR, F.lit("2022"))
            .when(year >= FIRST_KNOWN_YEAR, F.lit("2014")))


def year_layouts(urls: DataFrame) -> DataFrame:
    """P16 dispatch table: load (implemented layout), skip (known, not implemented), reject."""
    layout = year_layout(F.col("year"))
    action = (F.when(layout == "2022", "load").when(layout == "2014", "skip").otherwise("reject"))
    return urls.select("url", "year", layout.alias("layout"), action.alias("action"))
