"""C9-C11 pieces: columns, durations, stations, high-water mark, catalogue, layouts."""

import pytest
from pyspark.sql import functions as F

from headway.plans import bikeshare as bk

TRIPS = ("startStationName string, startStationArrondissement string, startStationLatitude double, "
         "startStationLongitude double, endStationName string, endStationArrondissement string, "
         "endStationLatitude double, endStationLongitude double, startTimeMs long, endTimeMs double")
# three rides between four docks; the last one repeats a dock under other coordinates
ROWS = [("Canal dock", "Harbour", 45.4821, -73.5702, "Mill dock", "Old Mill", 45.4909, -73.5555, 1680340000000, 1680340420000.0),
        ("Mill dock", "Old Mill", 45.4909, -73.5555, "Summit dock", "Heights", 45.5043, -73.5877, 1680350000000, 1680351500000.0),
        ("Orchard dock", "Heights", 45.5101, -73.6011, "Canal dock", "Quays", 45.4822, -73.5701, 1680360000000, 1680360090000.0)]


@pytest.mark.parametrize("header,ok", [
    (["a", "B"], True), (["A", "b", "c"], True), (["a"], False), ([], False)])
def test_required_columns_case_insensitive(header, ok):
    assert bk.has_required_columns(header, ["A", "b"]) is ok


def test_normalise_by_name(spark):
    raw = spark.createDataFrame(ROWS, TRIPS.upper().replace("STRING", "string").replace("DOUBLE", "double")
                                .replace("LONG", "long"))
    shuffled = raw.select(*reversed(raw.columns))
    out = bk.normalise_trip_columns(shuffled)
    assert out.columns == bk.REQUIRED_COLUMNS
    assert out.first().startStationName == "Canal dock"
    with pytest.raises(ValueError):
        bk.normalise_trip_columns(raw.drop("ENDTIMEMS"))


def test_durations(spark):
    out = bk.bike_trip_durations(spark.createDataFrame(ROWS, TRIPS)).collect()
    assert [r.durationMs for r in out] == [420000.0, 1500000.0, 90000.0]
    assert list(out[0].asDict()) == bk.TRIP_COLUMNS


def test_unique_stations(spark):
    out = {r.name: (r.arrondissement, r.latitude) for r in
           bk.station_locations(spark.createDataFrame(ROWS, TRIPS)).collect()}
    # a start role goes before an end role, whatever the time
    assert out == {"Canal dock": ("Harbour", 45.4821), "Mill dock": ("Old Mill", 45.4909),
                   "Summit dock": ("Heights", 45.5043), "Orchard dock": ("Heights", 45.5101)}
    assert bk.station_locations(spark.createDataFrame([], TRIPS)).count() == 0


def test_insert_if_absent_keeps_stored_rows(spark):
    new = bk.station_locations(spark.createDataFrame(ROWS, TRIPS))
    stored = spark.createDataFrame([("Summit dock", "before the move", 1.5, 2.5), ("Closed dock", "gone", 3.0, 4.0)],
                                   "name string, arrondissement string, latitude double, longitude double")
    out = {r.name: r.arrondissement for r in bk.stations_insert_if_absent(new, stored).collect()}
    assert out == {"Canal dock": "Harbour", "Mill dock": "Old Mill", "Summit dock": "before the move",
                   "Orchard dock": "Heights", "Closed dock": "gone"}


def test_high_water_mark(spark):
    untimed = ("Canal dock", None, None, None, "Mill dock", None, None, None, None, 7.0)
    trips = spark.createDataFrame([*ROWS, untimed], TRIPS)
    stored = spark.createDataFrame(ROWS[:2], TRIPS)
    got = [r.startTimeMs for r in bk.high_water_increment(trips, stored).collect()]
    assert got == [1680360000000]                              # strict '>', null start dropped
    empty = spark.createDataFrame([], TRIPS)
    assert bk.high_water_increment(trips, empty).count() == 4  # no mark: every row kept
    assert bk.high_water_increment(trips, mark=1680340000000).count() == 2


def _block(year, href, before=""):
    return (f'<section><div data-k="1" class="card document-row wide">{before}<h3 id="t" class="document-title title-4"> {year} </h3>'
            f'<p>rides</p><a rel="x" href="{href}">archive</a></div></section>')


def test_catalogue_links(spark):
    first = "<html><body><h1>Rides</h1>" + _block(2021, "https://files.example.net/r/2021.zip") + _block(
        2031, "https://files.example.net/r/2031.zip") + "</body></html>"
    second = (_block("n/a", "https://files.example.net/r/odd.zip") + _block(2022, "ftp://elsewhere.example/2022.zip")
              + _block(2025, "https://files.example.net/r/2025.zip", before='<div class="badge"><div>new</div></div>')
              + _block(99999999999, "https://files.example.net/r/huge.zip"))
    pages = spark.createDataFrame([(7, first), (9, second), (11, None), (12, "")], "page_id long, html string")
    got = [(r.year, r.url) for r in bk.catalogue_links(pages, "files.example.net", 2021, 2030).orderBy("year").collect()]
    assert got == [(2021, "https://files.example.net/r/2021.zip"), (2025, "https://files.example.net/r/2025.zip")]
    loaded = spark.createDataFrame([("https://files.example.net/r/2021.zip",)], "url string")
    new = bk.new_catalogue_entries(bk.catalogue_links(pages, "files.example.net", 2021, 2030), loaded)
    assert [r.year for r in new.collect()] == [2025]
    assert bk.has_new_entries(new)


def test_later_block_wins_for_a_year(spark):
    html = ('<div class="document-row"><h3 class="document-title title-4">2022</h3><a href="https://cdn.example.com/a.zip">'
            '</a></div><div class="document-row"><h3 class="document-title title-4">2022</h3>'
            '<a href="https://cdn.example.com/b.zip"></a></div>')
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert bk.catalogue_links(pages, "cdn.example.com").first().url == "https://cdn.example.com/b.zip"


def test_year_layouts(spark):
    urls = spark.createDataFrame([("u1", 2014), ("u2", 2022), ("u3", 2010), ("u4", 2030)], "url string, year int")
    got = {r.year: (r.layout, r.action) for r in bk.year_layouts(urls).collect()}
    assert got == {2014: ("2014", "skip"), 2022: ("2022", "load"), 2010: (None, "reject"), 2030: ("2022", "load")}


def test_mean_trip_duration(spark):
    slower = (*ROWS[0][:9], 1680340620000.0)
    out = bk.mean_trip_duration(spark.createDataFrame([*ROWS, slower], TRIPS)).orderBy("startStationName").collect()
    assert [(r.startStationName, r.mean_duration_ms, r.trip_count) for r in out] == [
        ("Canal dock", 520000.0, 2), ("Mill dock", 1500000.0, 1), ("Orchard dock", 90000.0, 1)]


def _year(text):
    return f'<h3 class="document-title title-4">{text}</h3>'


def _entries(spark, html):
    rows = bk.catalogue_entries(spark.createDataFrame([(1, html)], "page_id long, html string")).orderBy("pos").collect()
    return [(r.year, r.url) for r in rows]


def test_blocks_end_at_their_own_closing_tag(spark):
    html = ('<div class="document-row">' + _year(2020) + '</div><footer><a href="/terms">terms</a></footer>'       # no link of its own
            + '<div><div class="wide document-row"><div><div>box</div></div>' + _year(2021) + '<a href="/21">x</a></div></div>'
            + '<div class="document-row"><p>no year</p><a href="/none">x</a></div>' + _year(2030)
            + '<div class="document-rows">' + _year(2022) + '<a href="/22">x</a></div>')                           # another class
    assert _entries(spark, html) == [(2020, None), (2021, "/21"), (None, "/none")]


def test_nested_unclosed_and_stray_tags(spark):
    inner = '<div class="document-row">' + _year(2012) + '<a href="/in">x</a></div>'
    html = "</div></div>" + '<div class="document-row">' + inner + _year(2011) + '<a href="/out">x</a></div><a href="/after">x</a>'
    # the outer block holds the inner one: its first heading and link are those of the inner one
    assert _entries(spark, html) == [(2012, "/in"), (2012, "/in")]
    open_ = '<div class="document-row"><div>' + _year(2013) + '<p><a href="/open">x</a>'
    assert _entries(spark, open_) == [(2013, "/open")]


def test_quotes_entities_comments_and_scripts(spark):
    html = ("<!-- <div class='document-row'> --><script>var s = '<div class=\"document-row\">';</script>"
            "<DIV data-x='a > b' CLASS='document-row'>" + "<h3 id=a class='document-title title-4'><b> 2024 </b></h3>"
            "<a name=top>x</a><a title='href=\"no\"' HREF='/a?x=1&amp;y=2&#38;z=&#x26;lt;&quot;&#233;&#128690;&#0;&bogus;'>x</a></div>")
    assert _entries(spark, html) == [(2024, '/a?x=1&y=2&z=&lt;"é\U0001F6B2�&bogus;')]
    assert _entries(spark, "<div class=document-row>" + _year("soon") + "<a href=>x</a><a href=/plain>y</a></div>") == [(None, "/plain")]


def test_pages_of_many_tags(spark):
    block = '<div class="document-row"><div><div></div></div>' + _year(2025) + '<a href="/x">x</a></div>'
    assert _entries(spark, "<div>" * 3000 + "</div>" * 2990 + block * 400) == [(2025, "/x")] * 400
    assert _entries(spark, "no blocks, but the words document-row") == []


def test_station_places_are_aggregated_by_hash(spark):
    """Trips are not sorted for their stations; a start comes before an end, a missing time before all others."""
    trips = spark.createDataFrame([
        ("A", "x", 1.0, 1.0, "B", "p", 2.0, 2.0, 5, 6.0),
        ("A", "y", 1.5, 1.0, "B", "q", 2.0, 2.0, None, 6.0),
        ("A", "y", 1.5, 1.0, "C", "r", 3.0, None, 1, 6.0),
        ("D", "z", 4.0, 4.0, "A", "a", 0.0, 0.0, 0, 6.0),
        ("D", None, 4.0, 4.0, None, "s", 0.0, 0.0, 0, 6.0)], TRIPS)
    found = bk.station_locations(trips)
    assert {tuple(r) for r in found.collect()} == {("A", "y", 1.5, 1.0), ("B", "q", 2.0, 2.0), ("C", "r", 3.0, None),
                                                   ("D", None, 4.0, 4.0), (None, "s", 0.0, 0.0)}
    lines = found._jdf.queryExecution().sparkPlan().toString().splitlines()
    first = [line for line in lines if "Aggregate(" in line][-1]
    assert "HashAggregate(" in first and "role" in first
