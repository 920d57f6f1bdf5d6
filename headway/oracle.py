"""Reference SQL (DuckDB dialect) for every registered query.

Each text rebuilds the derived inputs (FIXTURES.md part B) as CTEs over the
pre-registered tables and computes the query the plain way: global
``LAG``/``LEAD`` windows over the whole sorted frame, grouped first/last
values, and so on.  Column names match the Spark results exactly.
"""

from __future__ import annotations

FX: dict[str, str] = {}

FX["fx_calendar"] = """
SELECT DISTINCT o_orderpriority || '/' || cast(o_custkey AS string) AS service_id,
 strftime(DATE '2023-11-01' + cast(o_custkey % 40 AS int), '%Y%m%d') AS start_date,
 strftime(DATE '2023-11-01' + cast(o_custkey % 40 + 15 + o_custkey % 30 AS int), '%Y%m%d') AS end_date,
 cast((o_custkey + 0) % 3 <> 0 AS int) AS monday, cast((o_custkey + 1) % 3 <> 0 AS int) AS tuesday, cast((o_custkey + 2) % 3 <> 0 AS int) AS wednesday, cast((o_custkey + 3) % 3 <> 0 AS int) AS thursday,
 cast((o_custkey + 4) % 3 <> 0 AS int) AS friday, cast((o_custkey + 5) % 3 <> 0 AS int) AS saturday, cast((o_custkey + 6) % 3 <> 0 AS int) AS sunday
FROM orders"""

FX["fx_trips"] = """
SELECT o_orderkey AS trip_id, o_orderpriority || '/' || cast(o_custkey AS string) AS service_id, o_orderkey % 97 AS route_id,
 'T' || cast(o_orderkey % 97 AS string) || '-' || CASE o_custkey % 5 WHEN 0 THEN 'E' WHEN 1 THEN 'O' WHEN 2 THEN 'S' WHEN 3 THEN 'N' ELSE 'X' END AS trip_headsign,
 o_custkey % 2 AS direction_id, 'S' || cast(o_orderkey % 97 AS string) || '_' || cast(o_custkey % 3 AS string) AS shape_id,
 o_custkey % 3 AS wheelchair_accessible
FROM orders"""

FX["fx_stop_times"] = """
WITH s AS (SELECT l_orderkey AS trip_id, cast(l_linenumber AS bigint) AS stop_sequence, min(l_partkey) AS stop_id FROM lineitem GROUP BY l_orderkey, l_linenumber),
 c AS (SELECT trip_id, stop_sequence, stop_id, (4 + trip_id % 22) * 3600 + stop_sequence * 420 + (trip_id * 7) % 60 AS sec FROM s),
 h AS (SELECT trip_id, stop_sequence, stop_id,
  lpad(cast(cast(floor(sec / 3600) AS bigint) AS string), 2, '0') || ':' || lpad(cast(cast(floor(sec / 60) AS bigint) % 60 AS string), 2, '0') || ':' || lpad(cast(sec % 60 AS string), 2, '0') AS arrival_time FROM c)
SELECT trip_id, arrival_time, arrival_time AS departure_time, stop_id, stop_sequence FROM h"""

FX["fx_stops"] = """
SELECT p_partkey AS stop_id, p_name AS stop_name, (4540 + p_size) / 100 AS stop_lat, (-7360 - p_size) / 100 AS stop_lon, p_size % 3 AS wheelchair_boarding
FROM part WHERE p_partkey % 10 <> 0"""

FX["fx_routes"] = """
SELECT DISTINCT o_orderkey % 97 AS route_id, 'Line ' || cast(o_orderkey % 97 AS string) AS route_long_name FROM orders WHERE o_orderkey % 97 < 90"""

FX["fx_positions"] = """
WITH p AS (SELECT l_orderkey AS trip_id, cast(l_linenumber AS bigint) AS seq, (l_partkey * 1000 + l_suppkey) % 2000000000 AS id, l_partkey, l_suppkey,
   min(l_returnflag) AS rf, min(l_linestatus) AS ls FROM lineitem GROUP BY l_orderkey, l_linenumber, l_partkey, l_suppkey),
 q AS (SELECT p.*, 1701406800 + (4 + trip_id % 22) * 3600 + seq * 420 + (trip_id * 7) % 60 + (l_partkey * 37 + l_suppkey * 101) % 2700 - 900 AS vts FROM p),
 r AS (SELECT q.*, 0 AS poll_day, 0 AS shift_s FROM q UNION ALL SELECT q.*, 1 AS poll_day, 86400 AS shift_s FROM q WHERE l_suppkey % 5 = 0)
SELECT poll_day, cast(id AS string) AS id, vts + shift_s + 11 AS timefetch, cast(trip_id AS string) AS vehicle_trip_tripId,
 cast(trip_id % 97 AS string) AS vehicle_trip_routeId, cast(cast(floor(trip_id / 3) AS bigint) AS string) AS vehicle_vehicle_id,
 cast(vts + shift_s AS string) AS vehicle_timestamp, CASE WHEN rf = 'N' THEN 'IN_TRANSIT_TO' ELSE 'STOPPED_AT' END AS vehicle_currentStatus,
 seq AS vehicle_currentStopSequence, CASE WHEN ls = 'O' THEN 'FULL' ELSE 'MANY_SEATS_AVAILABLE' END AS vehicle_occupancyStatus
FROM r"""

FX["fx_bike_csv"] = """
WITH t AS (SELECT l_suppkey AS a, (l_partkey * 7 + l_orderkey) % (SELECT count(*) FROM supplier) AS b, l_orderkey, l_linenumber, l_partkey, l_suppkey, max(l_quantity) AS qty
  FROM lineitem GROUP BY l_orderkey, l_linenumber, l_partkey, l_suppkey)
SELECT x.s_name AS STARTSTATIONNAME, nx.n_name AS STARTSTATIONARRONDISSEMENT, (4540 + x.s_nationkey) / 100 AS STARTSTATIONLATITUDE, (-7350 - x.s_nationkey) / 100 AS STARTSTATIONLONGITUDE,
 y.s_name AS ENDSTATIONNAME, ny.n_name AS ENDSTATIONARRONDISSEMENT, (4540 + y.s_nationkey) / 100 AS ENDSTATIONLATITUDE, (-7350 - y.s_nationkey) / 100 AS ENDSTATIONLONGITUDE,
 1709200000000 + (l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 31) % 2592000 * 1000 AS STARTTIMEMS,
 cast(1709200000000 + (l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 31) % 2592000 * 1000 AS double) + qty * 60000 AS ENDTIMEMS
FROM t JOIN supplier x ON x.s_suppkey = t.a JOIN supplier y ON y.s_suppkey = t.b
 JOIN nation nx ON nx.n_nationkey = x.s_nationkey JOIN nation ny ON ny.n_nationkey = y.s_nationkey"""

FX["fx_catalogue"] = """
SELECT page_id, coalesce(html, '') || '<section><div id=''first'' class="shade document-row"><div class="badge"><div>season</div></div>'
 || '<h3 class="document-title title-4"> ' || cast(2010 + page_id % 20 AS string) || ' </h3><a name="top">rides</a><a rel="archive" href=''https://cdn.example.com/rides/'
 || cast(page_id AS string) || '.csv.gz?part=1&amp;of=2''>rides</a></div><!-- <div class="document-row"> --><div class=''document-row''><h3 class="document-title title-4"> '
 || cast(2010 + page_id % 7 AS string) || ' </h3><a href="https://other.example.org/rides/' || cast(page_id AS string) || '">mirror</a></div>'
 || '<div class="document-row"><h3 class="document-title title-4"> ' || cast(2010 + page_id % 13 AS string) || ' </h3><p>to come</p></div></section>'
 || '<footer><a href="https://cdn.example.com/terms/' || cast(page_id AS string) || '">terms</a></footer>' AS html
FROM pages"""

FX["fx_page_urls"] = """
SELECT 'https://cdn.example.com/rides/' || cast(page_id AS string) || '.csv.gz?part=1&of=2' AS url, cast(2010 + page_id % 20 AS int) AS year FROM pages"""

FX["fx_loaded_urls"] = """
SELECT 'https://cdn.example.com/rides/' || cast(page_id AS string) || '.csv.gz?part=1&of=2' AS url, cast(2010 + page_id % 20 AS int) AS year FROM pages WHERE page_id % 3 = 0"""

FX["fx_station_status"] = """
SELECT cast(user_id AS string) AS station_id, event_id % 40 AS num_bikes_available, event_id % 2 AS is_renting, event_id AS last_reported FROM events"""

FX["fx_stored_stations"] = """
SELECT s_name AS name, 'stored ' || n_name AS arrondissement, (4540 + s_nationkey) / 100 AS latitude, (-7350 - s_nationkey) / 100 AS longitude
FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 2 = 0"""

FX["fx_source_versions"] = """
SELECT o_orderkey AS source_id, strftime(o_orderdate, '%a, %d %b %Y %H:%M:%S GMT') AS last_modified,
 strftime(CASE o_orderkey % 4 WHEN 1 THEN o_orderdate - INTERVAL 1 DAY WHEN 2 THEN o_orderdate WHEN 3 THEN o_orderdate + INTERVAL 1 DAY END,
          '%a, %d %b %Y %H:%M:%S GMT') AS stored_last_modified
FROM orders"""


def compose(deps: list[str], ctes: list[tuple[str, str]], final: str) -> str:
    parts = [f"{name} AS ({FX[name]}\n)" for name in deps]
    parts += [f"{name} AS ({body}\n)" for name, body in ctes]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + final


# ---------------------------------------------------------------- shared CTE chains

ORDER = "trip_id, vehicle_currentStopSequence, timefetch, vehicle_timestamp, id"

STU = ("stu", """
SELECT trip_id, arrival_time, stop_id, stop_sequence,
 1701406800 + cast(split_part(arrival_time, ':', 1) AS BIGINT) * 3600 + cast(split_part(arrival_time, ':', 2) AS BIGINT) * 60
   + cast(split_part(arrival_time, ':', 3) AS BIGINT) AS arrival_time_unix
FROM fx_stop_times""")

POS = ("pos", """
SELECT cast(id AS INTEGER) AS id, timefetch, cast(vehicle_trip_tripId AS BIGINT) AS trip_id, vehicle_trip_routeId, vehicle_vehicle_id,
 cast(vehicle_timestamp AS BIGINT) AS vehicle_timestamp, vehicle_currentStatus, vehicle_currentStopSequence, vehicle_occupancyStatus
FROM fx_positions WHERE poll_day IN (0, 1)""")

W1_EXACT = ("w1", f"""
SELECT *, vehicle_currentStopSequence <> LAG(vehicle_currentStopSequence) OVER (ORDER BY {ORDER}) AS changed FROM pos""")

W1_TRIP = ("w1", f"""
SELECT *, CASE WHEN row_number() OVER (PARTITION BY trip_id ORDER BY {ORDER}) = 1 THEN TRUE
 ELSE vehicle_currentStopSequence <> LAG(vehicle_currentStopSequence) OVER (PARTITION BY trip_id ORDER BY {ORDER}) END AS changed FROM pos""")

KEPT = ("kept", """
SELECT * EXCLUDE (changed) FROM w1 WHERE (changed AND vehicle_currentStatus = 'IN_TRANSIT_TO') OR vehicle_currentStatus = 'STOPPED_AT'""")

ON_SCHEDULE = ("sched", """
SELECT k.*, s.arrival_time, s.stop_id, s.arrival_time_unix
FROM kept k JOIN stu s ON k.trip_id = s.trip_id AND k.vehicle_currentStopSequence = s.stop_sequence
WHERE s.arrival_time_unix IS NOT NULL AND k.vehicle_timestamp IS NOT NULL AND abs(k.timefetch - s.arrival_time_unix) <= 7200""")

NEIGHBOURS = ("nb", f"""
SELECT sched.*, LEAD(trip_id) OVER o AS n_trip, LEAD(vehicle_vehicle_id) OVER o AS n_vid, LEAD(vehicle_timestamp) OVER o AS n_vts,
 max(vehicle_currentStopSequence) OVER (PARTITION BY trip_id) AS max_seq
FROM sched WINDOW o AS (ORDER BY {ORDER})""")

R1 = ("r1", """
SELECT nb.*, CASE WHEN vehicle_currentStatus = 'STOPPED_AT' THEN vehicle_timestamp - arrival_time_unix END AS off1 FROM nb""")

R2 = ("r2", """
SELECT r1.*, CASE WHEN vehicle_currentStatus = 'IN_TRANSIT_TO' AND n_trip = trip_id THEN n_vts - arrival_time_unix ELSE off1 END AS off2 FROM r1""")

R3 = ("r3", """
SELECT r2.*, CASE WHEN vehicle_currentStatus <> 'STOPPED_AT' AND vehicle_vehicle_id = n_vid AND vehicle_currentStopSequence = max_seq
 THEN n_vts - arrival_time_unix ELSE off2 END AS off3 FROM r2""")

AD = ("ad", """
SELECT r3.*, first_value(off3) OVER g AS arrival_time_offset, last_value(off3) OVER g AS departure_time_offset
FROM r3 WINDOW g AS (PARTITION BY trip_id, vehicle_currentStopSequence ORDER BY timefetch, vehicle_timestamp, id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")

ONE = ("one", """
SELECT * FROM (SELECT ad.*, row_number() OVER (PARTITION BY trip_id, vehicle_currentStopSequence ORDER BY timefetch, vehicle_timestamp, id) AS rn
               FROM ad WHERE abs(off3) <= 1800) WHERE rn = 1""")

DATA_STOPS = ("data_stops", """
SELECT s.trip_id, s.arrival_time, s.stop_id, s.stop_sequence, s.arrival_time_unix, one.id AS vehicleID,
 one.vehicle_occupancyStatus AS Current_Occupancy, (one.arrival_time_offset + one.departure_time_offset) / 2 AS "offset",
 cast(one.vehicle_trip_routeId AS BIGINT) AS routeId, one.arrival_time_offset, one.departure_time_offset
FROM stu s JOIN one ON s.trip_id = one.trip_id AND s.stop_sequence = one.vehicle_currentStopSequence""")

PUNCTUALITY_CHAIN = [STU, POS, W1_EXACT, KEPT, ON_SCHEDULE, NEIGHBOURS, R1, R2, R3, AD, ONE, DATA_STOPS]

POSITION_COLS = ("id, timefetch, trip_id, vehicle_trip_routeId, vehicle_vehicle_id, vehicle_timestamp, "
                 "vehicle_currentStatus, vehicle_currentStopSequence, vehicle_occupancyStatus")
SCHED_COLS = POSITION_COLS + ", arrival_time, stop_id, arrival_time_unix"

SEGMENTS = ("seg", """
SELECT * FROM (
 SELECT trip_id, routeId, stop_id, LAG(stop_id) OVER o AS previous_stop_id,
   "offset" - LAG("offset") OVER o AS diff, LAG(trip_id) OVER o AS previous_trip_id, Current_Occupancy, arrival_time_unix
 FROM data_stops WHERE "offset" IS NOT NULL WINDOW o AS (ORDER BY trip_id, stop_sequence, arrival_time_unix))
WHERE trip_id = previous_trip_id AND diff IS NOT NULL""")

SEG_SELECT = ("SELECT trip_id, routeId, stop_id, previous_stop_id, cast(trunc(diff) AS BIGINT) AS offset_difference, "
              "Current_Occupancy, arrival_time_unix FROM seg")

ROUTE_SHAPES = ("shapes", "SELECT route_id, arg_min(shape_id, trip_id) AS shape_id FROM fx_trips GROUP BY route_id")

QUERIES: dict[str, str] = {}

QUERIES["stop_times_unix"] = compose(["fx_stop_times"], [STU], "SELECT * FROM stu")

QUERIES["two_day_positions"] = compose(["fx_positions"], [POS], "SELECT * FROM pos")

QUERIES["filter_positions"] = compose(["fx_positions"], [POS, W1_TRIP, KEPT], f"SELECT {POSITION_COLS} FROM kept")

QUERIES["filter_positions_exact"] = compose(["fx_positions"], [POS, W1_EXACT, KEPT], f"SELECT {POSITION_COLS} FROM kept")

QUERIES["positions_on_schedule"] = compose(
    ["fx_positions", "fx_stop_times"], [STU, POS, W1_EXACT, KEPT, ON_SCHEDULE], f"SELECT {SCHED_COLS} FROM sched")

QUERIES["offsets_stopped"] = compose(
    ["fx_positions", "fx_stop_times"], PUNCTUALITY_CHAIN[:7], f'SELECT {SCHED_COLS}, off1 AS "offset" FROM r1')

QUERIES["offsets_in_transit"] = compose(
    ["fx_positions", "fx_stop_times"], PUNCTUALITY_CHAIN[:8], f'SELECT {SCHED_COLS}, off2 AS "offset" FROM r2')

QUERIES["offsets_last_stop"] = compose(
    ["fx_positions", "fx_stop_times"], PUNCTUALITY_CHAIN[:9], f'SELECT {SCHED_COLS}, off3 AS "offset" FROM r3')

QUERIES["arrival_departure_offsets"] = compose(
    ["fx_positions", "fx_stop_times"], PUNCTUALITY_CHAIN[:10],
    f'SELECT {SCHED_COLS}, off3 AS "offset", arrival_time_offset, departure_time_offset FROM ad WHERE abs(off3) <= 1800')

QUERIES["stop_punctuality"] = compose(
    ["fx_positions", "fx_stop_times"], PUNCTUALITY_CHAIN, "SELECT * FROM data_stops")

QUERIES["segment_deltas"] = compose(
    ["fx_positions", "fx_stop_times"], PUNCTUALITY_CHAIN + [SEGMENTS], SEG_SELECT)

QUERIES["route_shape_map"] = compose(["fx_trips"], [ROUTE_SHAPES], "SELECT * FROM shapes")

QUERIES["segment_delays"] = compose(
    ["fx_positions", "fx_stop_times", "fx_trips"],
    PUNCTUALITY_CHAIN + [SEGMENTS, ("segsel", SEG_SELECT), ROUTE_SHAPES],
    "SELECT g.*, s.shape_id FROM segsel g LEFT JOIN shapes s ON g.routeId = s.route_id")

# ---------------------------------------------------------------- schedule

ACTIVE = ("active", """
SELECT service_id FROM fx_calendar
WHERE strptime(start_date, '%Y%m%d')::DATE <= DATE '2023-12-01' AND strptime(end_date, '%Y%m%d')::DATE >= DATE '2023-12-01'
  AND friday = 1""")
FTRIPS = ("ftrips", "SELECT a.service_id, t.trip_id, t.route_id, t.trip_headsign, t.direction_id, t.shape_id, "
                    "t.wheelchair_accessible FROM active a JOIN fx_trips t ON a.service_id = t.service_id")
FSTOP_TIMES = ("fst", "SELECT * FROM fx_stop_times WHERE trip_id IN (SELECT trip_id FROM ftrips)")
UNIX_EXPR = ("1701406800 + cast(split_part(arrival_time, ':', 1) AS BIGINT) * 3600 + cast(split_part(arrival_time, ':', 2) AS BIGINT) * 60"
             " + cast(split_part(arrival_time, ':', 3) AS BIGINT)")

QUERIES["active_services"] = compose(["fx_calendar"], [ACTIVE], "SELECT * FROM active")
QUERIES["filtered_trips"] = compose(["fx_calendar", "fx_trips"], [ACTIVE, FTRIPS], "SELECT * FROM ftrips")
QUERIES["filtered_stop_times"] = compose(["fx_calendar", "fx_trips", "fx_stop_times"], [ACTIVE, FTRIPS, FSTOP_TIMES],
                                         "SELECT * FROM fst")
QUERIES["stop_times_unix_wall"] = compose(["fx_stop_times"], [],
                                          f"SELECT *, {UNIX_EXPR} AS arrival_time_unix FROM fx_stop_times")
QUERIES["daily_stops_info"] = compose(
    ["fx_calendar", "fx_trips", "fx_stop_times", "fx_stops", "fx_routes"], [ACTIVE, FTRIPS, FSTOP_TIMES], f"""
SELECT t.route_id,
 cast(t.route_id AS string) || ' ' || r.route_long_name || ' dir. ' ||
   CASE right(t.trip_headsign, 1) WHEN 'E' THEN 'EST' WHEN 'O' THEN 'OUEST' WHEN 'S' THEN 'SUD' WHEN 'N' THEN 'NORD'
   ELSE right(t.trip_headsign, 1) END AS route_info,
 st.trip_id, t.shape_id, t.wheelchair_accessible, {UNIX_EXPR.replace('arrival_time', 'st.arrival_time')} AS arrival_time_unix,
 cast(st.stop_id AS string) AS stop_id, s.stop_name, s.stop_lat, s.stop_lon, s.wheelchair_boarding
FROM fst st LEFT JOIN ftrips t ON st.trip_id = t.trip_id
 LEFT JOIN fx_stops s ON cast(st.stop_id AS string) = cast(s.stop_id AS string)
 LEFT JOIN fx_routes r ON t.route_id = r.route_id""")

# ---------------------------------------------------------------- feeds

QUERIES["feed_flatten"] = compose(["fx_positions"], [], """
SELECT id, vehicle_currentStatus, vehicle_currentStopSequence, vehicle_occupancyStatus, vehicle_timestamp,
 vehicle_trip_routeId, vehicle_trip_tripId, vehicle_vehicle_id FROM fx_positions""")
QUERIES["trip_updates_flatten"] = compose(["fx_stop_times"], [], """
SELECT cast(trip_id AS string) AS tripUpdate_trip_tripId, count(*) AS stop_updates,
 cast(sum(stop_sequence) AS BIGINT) AS stop_sequence_sum FROM fx_stop_times GROUP BY trip_id""")
QUERIES["station_snapshot"] = compose(["fx_station_status"], [], "SELECT * FROM fx_station_status")
QUERIES["merge_drifted_polls"] = compose(["fx_positions"], [], """
SELECT id, poll_day, timefetch, vehicle_currentStatus, vehicle_currentStopSequence, NULL::VARCHAR AS vehicle_occupancyStatus,
 vehicle_timestamp, vehicle_trip_routeId, vehicle_trip_tripId, vehicle_vehicle_id FROM fx_positions WHERE poll_day = 0
UNION ALL
SELECT id, poll_day, timefetch, vehicle_currentStatus, vehicle_currentStopSequence, vehicle_occupancyStatus,
 vehicle_timestamp, vehicle_trip_routeId, vehicle_trip_tripId, NULL::VARCHAR AS vehicle_vehicle_id FROM fx_positions WHERE poll_day = 1""")

# ---------------------------------------------------------------- bike share

TRIPS = ("trips", """
SELECT STARTSTATIONNAME AS startStationName, STARTSTATIONARRONDISSEMENT AS startStationArrondissement,
 STARTSTATIONLATITUDE AS startStationLatitude, STARTSTATIONLONGITUDE AS startStationLongitude,
 ENDSTATIONNAME AS endStationName, ENDSTATIONARRONDISSEMENT AS endStationArrondissement,
 ENDSTATIONLATITUDE AS endStationLatitude, ENDSTATIONLONGITUDE AS endStationLongitude,
 STARTTIMEMS AS startTimeMs, ENDTIMEMS AS endTimeMs FROM fx_bike_csv""")
DURATIONS = ("dur", "SELECT startStationName, endStationName, startTimeMs, endTimeMs, endTimeMs - startTimeMs AS durationMs FROM trips")
STATIONS = ("stations", """
SELECT name, arrondissement, latitude, longitude FROM (
 SELECT *, row_number() OVER (PARTITION BY name ORDER BY role, t, arrondissement, latitude, longitude) AS rn FROM (
  SELECT startStationName AS name, startStationArrondissement AS arrondissement, startStationLatitude AS latitude,
         startStationLongitude AS longitude, 0 AS role, startTimeMs AS t FROM trips
  UNION ALL
  SELECT endStationName, endStationArrondissement, endStationLatitude, endStationLongitude, 1, startTimeMs FROM trips))
WHERE rn = 1""")

QUERIES["bike_trip_durations"] = compose(["fx_bike_csv"], [TRIPS, DURATIONS], "SELECT * FROM dur")
QUERIES["high_water_increment"] = compose(["fx_bike_csv"], [TRIPS, DURATIONS, (
    "mark", "SELECT max(startTimeMs) AS m FROM dur WHERE startTimeMs <= 1710000000000")],
    "SELECT dur.* FROM dur WHERE (SELECT m FROM mark) IS NULL OR startTimeMs > (SELECT m FROM mark)")
QUERIES["station_locations"] = compose(["fx_bike_csv"], [TRIPS, STATIONS], "SELECT * FROM stations")
QUERIES["stations_insert_if_absent"] = compose(["fx_bike_csv", "fx_stored_stations"], [TRIPS, STATIONS], """
SELECT name, arrondissement, latitude, longitude FROM fx_stored_stations
UNION ALL
SELECT * FROM stations WHERE name NOT IN (SELECT name FROM fx_stored_stations)""")
QUERIES["mean_trip_duration"] = compose(["fx_bike_csv"], [TRIPS, DURATIONS], """
SELECT startStationName, endStationName, avg(durationMs) AS mean_duration_ms, count(*) AS trip_count
FROM dur GROUP BY startStationName, endStationName""")

_ATTRIBUTES = r"""(?:[^"'>]|"[^"]*"|'[^']*')*"""


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


_DIV = _quoted(rf"(?i)<div\b{_ATTRIBUTES}>|</div\s*>")


def _attribute(tag: str, name: str) -> str:
    found = f"""regexp_extract({tag}, {_quoted(rf"""(?is)\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")}, 1)"""
    return f"""CASE WHEN {found} <> '' THEN replace(regexp_replace({found}, {_quoted("""^["']|["']$""")}, '', 'g'), '&amp;', '&') END"""


# Div tags with a running depth; a tag and the next one of its level on the page are a pair.
BLOCKS = ("blocks", rf"""
WITH pages AS (
 SELECT page_id, regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'g') AS html
 FROM fx_catalogue WHERE contains(html, 'document-row')),
cut AS (SELECT page_id, html, regexp_extract_all(html, {_DIV}) AS tags, string_split_regex(html, {_DIV}) AS texts FROM pages),
tokens AS (SELECT page_id, html, unnest(range(1, len(tags) + 1)) AS i, tags, texts FROM cut),
placed AS (
 SELECT page_id, html, i, tags[i] AS tag, sum(length(texts[i]) + length(tags[i])) OVER w AS after,
  sum(CASE WHEN starts_with(tags[i], '</') THEN -1 ELSE 1 END) OVER w AS raw FROM tokens WINDOW w AS (PARTITION BY page_id ORDER BY i)),
deep AS (SELECT *, raw - least(0, min(raw) OVER (PARTITION BY page_id ORDER BY i)) AS depth FROM placed),
levels AS (SELECT *, CASE WHEN starts_with(tag, '</') THEN lag(depth, 1, 0) OVER (PARTITION BY page_id ORDER BY i) ELSE depth END AS level FROM deep),
pairs AS (SELECT *, lead(after - length(tag)) OVER (PARTITION BY page_id, level ORDER BY i) AS stop FROM levels)
SELECT page_id, i AS pos, substring(html, after::BIGINT + 1, (coalesce(stop, length(html)) - after)::BIGINT) AS block FROM pairs
WHERE NOT starts_with(tag, '</') AND list_contains(string_split_regex(trim({_attribute("tag", "class")}), '\s+'), 'document-row')""")
LINKS = ("links", rf"""
SELECT page_id, pos,
 try_cast(trim(regexp_replace(list_filter(regexp_extract_all(block, {_quoted(rf"(?is)<h3\b{_ATTRIBUTES}>.*?</h3\s*>")}),
   lambda h: {_attribute(f"regexp_extract(h, {_quoted(rf'(?i)^<h3{_ATTRIBUTES}>')})", "class")} = 'document-title title-4')[1], '(?s)<[^>]*>', '', 'g')) AS INTEGER) AS year,
 list_filter(list_transform(regexp_extract_all(block, {_quoted(rf"(?i)<a\b{_ATTRIBUTES}>")}), lambda a: {_attribute("a", "href")}), lambda u: u IS NOT NULL)[1] AS url
FROM blocks""")
CATALOGUE = ("cat", """
SELECT year, url FROM (
 SELECT *, row_number() OVER (PARTITION BY year ORDER BY page_id DESC, pos DESC) AS rn FROM links
 WHERE contains(url, 'cdn.example.com') AND year BETWEEN 2014 AND 2099) WHERE rn = 1""")

QUERIES["catalogue_links"] = compose(["fx_catalogue"], [BLOCKS, LINKS, CATALOGUE], "SELECT * FROM cat")
QUERIES["new_catalogue_entries"] = compose(["fx_catalogue", "fx_loaded_urls"], [BLOCKS, LINKS, CATALOGUE],
                                           "SELECT year, url FROM cat WHERE url NOT IN (SELECT url FROM fx_loaded_urls)")
QUERIES["trusted_urls"] = r"""
SELECT page_id, url, 'https://cdn.example.com' ||
 regexp_replace(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1), ';[^/]*$', '') AS trusted_url
FROM pages"""
QUERIES["year_layouts"] = compose(["fx_page_urls"], [], """
SELECT url, year,
 CASE WHEN year >= 2022 THEN '2022' WHEN year >= 2014 THEN '2014' END AS layout,
 CASE WHEN year >= 2022 THEN 'load' WHEN year >= 2014 THEN 'skip' ELSE 'reject' END AS action
FROM fx_page_urls""")

# ---------------------------------------------------------------- static refresh

QUERIES["freshness_gate"] = compose(["fx_source_versions"], [], """
SELECT source_id, last_modified, stored_last_modified,
 stored_last_modified IS NULL OR strptime(last_modified, '%a, %d %b %Y %H:%M:%S GMT')
                                 > strptime(stored_last_modified, '%a, %d %b %Y %H:%M:%S GMT') AS reload
FROM fx_source_versions""")

QUERIES["stop_punctuality_per_trip"] = compose(
    ["fx_positions", "fx_stop_times"], [STU, POS, W1_TRIP] + PUNCTUALITY_CHAIN[3:], "SELECT * FROM data_stops")
QUERIES["stop_times_unix_wall_strict"] = QUERIES["stop_times_unix_wall"]

QUERIES["services_by_day"] = compose(["fx_positions", "fx_calendar"], [
    ("days", "SELECT DISTINCT DATE '2023-12-01' + poll_day AS service_date FROM fx_positions")], """
SELECT d.service_date, c.service_id
FROM days d JOIN fx_calendar c
  ON d.service_date BETWEEN strptime(c.start_date, '%Y%m%d')::DATE AND strptime(c.end_date, '%Y%m%d')::DATE
WHERE CASE lower(dayname(d.service_date)) WHEN 'monday' THEN c.monday WHEN 'tuesday' THEN c.tuesday
  WHEN 'wednesday' THEN c.wednesday WHEN 'thursday' THEN c.thursday WHEN 'friday' THEN c.friday
  WHEN 'saturday' THEN c.saturday ELSE c.sunday END = 1""")

# Local midnight of 2023-11-05 is 1699156800; from 02:00 on, the clock is an hour behind.
_CHANGE = """
SELECT {cols}, 1699156800 + h * 3600 + cast(split_part(arrival_time, ':', 2) AS BIGINT) * 60
   + cast(split_part(arrival_time, ':', 3) AS BIGINT) + CASE WHEN {late} THEN 3600 ELSE 0 END AS arrival_time_unix
FROM (SELECT *, cast(split_part(arrival_time, ':', 1) AS BIGINT) AS h FROM fx_stop_times)"""
QUERIES["stop_times_unix_clock_change"] = compose(["fx_stop_times"], [], _CHANGE.format(
    cols="trip_id, arrival_time, stop_id, stop_sequence", late="h % 24 >= 2"))
QUERIES["stop_times_unix_wall_clock_change"] = compose(["fx_stop_times"], [], _CHANGE.format(
    cols="trip_id, arrival_time, departure_time, stop_id, stop_sequence", late="h >= 2"))

QUERIES["readable_sizes"] = """
SELECT doc_id, CASE WHEN b < 1024 THEN printf('%.1f B', b) WHEN b < 1048576 THEN printf('%.1f KiB', b / 1024)
 WHEN b < 1073741824 THEN printf('%.1f MiB', b / 1048576) ELSE printf('%.1f GiB', b / 1073741824) END AS size
FROM (SELECT doc_id, cast(n_chars * 1009 AS DOUBLE) AS b FROM documents)"""
QUERIES["poll_times_from_names"] = """
SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN 1701400000 + event_id END AS timefetch FROM events"""
QUERIES["day_partitions"] = compose(["fx_positions"], [], """
SELECT DATE '2023-12-01' + poll_day AS service_date, count(*) AS polls, cast(sum(timefetch) AS BIGINT) AS time_sum
FROM fx_positions GROUP BY poll_day""")

# ---------------------------------------------------------------- jobs on files

_DRIFTED = """
SELECT id, timefetch, vehicle_currentStatus, vehicle_currentStopSequence,
 CASE WHEN cast(vehicle_trip_tripId AS BIGINT) % 2 = 0 THEN vehicle_occupancyStatus END AS vehicle_occupancyStatus, vehicle_timestamp,
 vehicle_trip_routeId, vehicle_trip_tripId, CASE WHEN cast(vehicle_trip_tripId AS BIGINT) % 2 = 1 THEN vehicle_vehicle_id END AS vehicle_vehicle_id,
 {day} AS service_date FROM fx_positions"""
_LOCAL_DAY = "DATE '2023-12-01' + cast(floor((timefetch - 1701406800) / 86400) AS INTEGER)"
QUERIES["merge_day"] = compose(["fx_positions"], [], _DRIFTED.format(day="DATE '2023-12-01' + cast(poll_day AS INTEGER)"))
QUERIES["landed_stream"] = compose(["fx_positions"], [], _DRIFTED.format(day=_LOCAL_DAY))
QUERIES["gtfs_table"] = compose(["fx_stop_times"], [], """
SELECT cast(trip_id AS VARCHAR) AS trip_id, arrival_time, departure_time, cast(stop_id AS VARCHAR) AS stop_id, stop_sequence FROM fx_stop_times""")
QUERIES["static_tables"] = compose(["fx_calendar"], [], "SELECT * FROM fx_calendar")
QUERIES["segments_indexed"] = compose(
    ["fx_positions", "fx_stop_times", "fx_trips"],
    PUNCTUALITY_CHAIN + [SEGMENTS, ("segsel", SEG_SELECT), ROUTE_SHAPES],
    'SELECT g.*, s.shape_id, row_number() OVER (ORDER BY trip_id, arrival_time_unix, stop_id) - 1 AS "index" '
    "FROM segsel g LEFT JOIN shapes s ON g.routeId = s.route_id")
QUERIES["bike_history_trips"] = compose(["fx_bike_csv"], [TRIPS, DURATIONS], "SELECT * FROM dur")
QUERIES["bike_history_ledger"] = compose(["fx_bike_csv"], [TRIPS, (
    "named", "SELECT startStationName AS name, startTimeMs AS t FROM trips UNION ALL SELECT endStationName, startTimeMs FROM trips")], """
SELECT 2023 AS year, 'https://cdn.example.com/rides/first.zip' AS url, (SELECT count(*) FROM trips WHERE startTimeMs <= 1710000000000) AS trips,
 (SELECT count(DISTINCT name) FROM named WHERE t <= 1710000000000) AS stations
UNION ALL
SELECT 2024, 'https://cdn.example.com/rides/second.zip', (SELECT count(*) FROM trips WHERE startTimeMs > 1710000000000),
 (SELECT count(DISTINCT name) FROM named WHERE name NOT IN (SELECT name FROM named WHERE t <= 1710000000000))""")
QUERIES["bike_stream"] = compose(["fx_bike_csv"], [TRIPS, DURATIONS], "SELECT * FROM dur")
QUERIES["compacted_day"] = compose(["fx_positions"], [("polls", """
SELECT cast(floor(timefetch / 1800) * 1800 AS BIGINT) AS timefetch, vehicle_occupancyStatus FROM fx_positions WHERE poll_day = 0""")], f"""
SELECT timefetch, CASE WHEN timefetch = 1701406800 + 43200 THEN 'EMPTY' ELSE vehicle_occupancyStatus END AS vehicle_occupancyStatus, count(*) AS polls
FROM polls WHERE {_LOCAL_DAY} = DATE '2023-12-01' GROUP BY ALL""")
QUERIES["table_statistics"] = compose(["fx_positions"], [], """
SELECT count(*) AS rows, true AS has_bytes, true AS mean_fits, true AS size_reads FROM fx_positions""")
QUERIES["positions_on_bucketed_schedule"] = QUERIES["positions_on_schedule"]
QUERIES["daily_stops_info_bucketed"] = QUERIES["daily_stops_info"]
