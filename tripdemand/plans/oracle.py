"""DuckDB SQL for each registered query, over the same parquet tables.

The fixture rules are restated in SQL (FIXTURES.md section 3), so each
query is checked end to end: line building, parsing, joins, aggregation.
"""

from __future__ import annotations

# Fixed patterns shared with the Spark side.
_INT = r"^\s*[+-]?[0-9]+\s*$"
_FLOAT = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity|nan))\s*$"
_TS = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\s+[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$"

ZONES = """zones AS (
  SELECT CAST(n.n_nationkey AS VARCHAR) AS zone_code, r.r_name AS borough_name
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)"""

BASE = """base AS (
  SELECT event_id, ts, CAST(user_id % 2 + 1 AS VARCHAR) AS v,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS p, CAST(event_id % 4 + 1 AS VARCHAR) AS pc,
         CAST(event_id % 30 AS VARCHAR) AS z,
         CAST((event_id % 211) // 10 AS VARCHAR) || '.' || CAST((event_id % 211) % 10 AS VARCHAR) || '13' AS lon,
         CAST((event_id % 197) // 10 AS VARCHAR) || '.' || CAST((event_id % 197) % 10 AS VARCHAR) || '07' AS lat
  FROM events)"""

ZONE_LINES = """zone_lines AS (
  SELECT event_id, CASE WHEN event_id % 97 = 0 THEN concat_ws(',', v, p, p)
    ELSE concat_ws(',', v, p, p, pc, '1.0', '1', 'N',
                   CASE WHEN event_id % 89 = 0 THEN 'zz' ELSE z END, z) END AS value
  FROM base)"""

GPS_LINES = """gps_lines AS (
  SELECT event_id, CASE WHEN event_id % 97 = 0 THEN concat_ws(',', v, p, p)
    ELSE concat_ws(',', v, p, p, pc, '1.0', glon, glat, '1', 'N', glon, glat,
                   'CSH', '5.0', '0.5', '0.5', '0.0', '0.0', '6.0') END AS value
  FROM (SELECT *, CASE WHEN event_id % 89 = 0 THEN 'zz' ELSE lon END AS glon,
                  CASE WHEN event_id % 83 = 0 THEN '0' ELSE lat END AS glat FROM base))"""

ZONE_TRIPS = f"""zone_fields AS (
  SELECT string_split(regexp_replace(value, '\\s+$', ''), ',') AS f FROM zone_lines),
zone_valid AS (
  SELECT try_strptime(f[2], '%Y-%m-%d %H:%M:%S') AS ts, f[2] AS pt, f[8] AS zone_code
  FROM zone_fields WHERE len(f) >= 7 AND regexp_matches(zone_code, '{_INT}')),
zone_trips AS (
  SELECT t.ts AS pickup_ts, CAST((hour(t.ts) * 60 + minute(t.ts)) // 10 AS INTEGER) AS time_block,
         monthname(t.ts) AS "month", dayname(t.ts) AS "day", z.borough_name
  FROM zone_valid t JOIN zones z ON t.zone_code = z.zone_code
  WHERE regexp_matches(t.pt, '{_TS}') AND t.ts IS NOT NULL)"""

EDGES = """edges(code, name, x1, y1, x2, y2) AS (VALUES
  (1, 'Manhattan', 0.0, 0.0, 10.0, 0.0), (1, 'Manhattan', 10.0, 0.0, 0.0, 10.0),
  (1, 'Manhattan', 0.0, 10.0, 0.0, 0.0),
  (2, 'Bronx', 10.0, 10.0, 20.0, 10.0), (2, 'Bronx', 20.0, 10.0, 20.0, 20.0),
  (2, 'Bronx', 20.0, 20.0, 10.0, 20.0), (2, 'Bronx', 10.0, 20.0, 10.0, 10.0))"""


def _located(points: str, out: str) -> str:
    """Even-odd ray test per polygon; smallest code wins; none -> EWR."""
    return f"""{out}_hits AS (
  SELECT q.pid, e.code, e.name, count(*) AS n
  FROM {points} q JOIN edges e
    ON ((e.y1 > q.y) <> (e.y2 > q.y)) AND q.x < (e.x2 - e.x1) * (q.y - e.y1) / (e.y2 - e.y1) + e.x1
  GROUP BY q.pid, e.code, e.name),
{out}_in AS (
  SELECT pid, arg_min(name, code) AS borough_name FROM {out}_hits WHERE n % 2 = 1 GROUP BY pid),
{out} AS (
  SELECT q.*, coalesce(i.borough_name, 'EWR') AS borough_name
  FROM {points} q LEFT JOIN {out}_in i ON q.pid = i.pid)"""


GPS_TRIPS = f"""gps_fields AS (
  SELECT event_id AS pid, string_split(regexp_replace(value, '\\s+$', ''), ',') AS f
  FROM gps_lines),
gps_valid AS (
  SELECT pid, try_strptime(f[2], '%Y-%m-%d %H:%M:%S') AS ts, f[2] AS pt,
         CAST(f[6] AS DOUBLE) AS x, CAST(f[7] AS DOUBLE) AS y
  FROM gps_fields
  WHERE len(f) >= 7 AND regexp_matches(f[6], '{_FLOAT}') AND regexp_matches(f[7], '{_FLOAT}')),
gps_pts AS (
  SELECT * FROM gps_valid
  WHERE x <> 0 AND y <> 0 AND regexp_matches(pt, '{_TS}') AND ts IS NOT NULL),
{_located("gps_pts", "gps_loc")},
gps_trips AS (
  SELECT CAST(ts AS DATE) AS assign_date,
         CAST((hour(ts) * 60 + minute(ts)) // 10 AS INTEGER) AS time_block,
         monthname(ts) AS "month", dayname(ts) AS "day", borough_name
  FROM gps_loc)"""

COUNTS = """counts AS (
  SELECT CAST(pickup_ts AS DATE) AS assign_date, time_block, "month", "day", borough_name,
         count(*) AS num_trips
  FROM zone_trips GROUP BY ALL)"""

STATS = """stats AS (
  SELECT time_block, "day", "month", borough_name, avg(num_trips) AS mean,
         CAST(trunc(avg(num_trips)) AS INTEGER) AS mean_int
  FROM counts GROUP BY time_block, "day", "month", borough_name)"""

LIVE = """live AS (
  SELECT borough_name, time_block, "month", "day", min(CAST(pickup_ts AS DATE)) AS assign_date,
         count(*) AS actual_trips
  FROM zone_trips GROUP BY borough_name, time_block, "month", "day"),
day_stats AS (
  SELECT time_block, borough_name, mean FROM stats WHERE "day" = 'Thursday' AND "month" = 'January'),
live_stats AS (
  SELECT l.assign_date, l.time_block, l."month", l."day",
         l.borough_name, l.actual_trips, s.mean
  FROM live l JOIN day_stats s ON l.borough_name = s.borough_name AND l.time_block = s.time_block)"""

LABEL = "printf('%02d:%02d', (time_block * 10) // 60, (time_block * 10) % 60)"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_ZONE_CHAIN = (ZONES, BASE, ZONE_LINES, ZONE_TRIPS)

ORACLE_SQL: dict[str, str] = {
    "parse_zone_trips": _with(*_ZONE_CHAIN)
    + 'SELECT pickup_ts, time_block, "month", "day", borough_name FROM zone_trips',

    "parse_zone_trips_as_coded": _with(*_ZONE_CHAIN[:3], ZONE_TRIPS.replace("f[8] AS zone_code", "f[6] AS zone_code"))
    + 'SELECT pickup_ts, time_block, "month", "day", borough_name FROM zone_trips',

    "parse_gps_trips": _with(BASE, GPS_LINES, EDGES, GPS_TRIPS) + "SELECT * FROM gps_trips",

    "time_features": """SELECT event_id, CAST((hour(ts) * 60 + minute(ts)) // 10 AS INTEGER) AS time_block,
       monthname(ts) AS "month", dayname(ts) AS "day" FROM events""",

    "block_label": f"""SELECT time_block, {LABEL} AS label FROM (
  SELECT DISTINCT CAST((hour(ts) * 60 + minute(ts)) // 10 AS INTEGER) AS time_block FROM events)""",

    "zone_lookup_join": _with(ZONES) + """SELECT e.event_id, z.borough_name
FROM events e JOIN zones z ON CAST(e.event_id % 30 AS VARCHAR) = z.zone_code""",

    "borough_point_join": _with(
        EDGES,
        """pts AS (SELECT event_id AS pid, (event_id % 211) / 10 + 0.013 AS x,
                 (event_id % 197) / 10 + 0.007 AS y FROM events)""",
        _located("pts", "loc")) + "SELECT pid AS event_id, borough_name FROM loc",

    "all_trips_union": _with(*_ZONE_CHAIN, GPS_LINES, EDGES, GPS_TRIPS) + """SELECT assign_date, time_block, "month", "day", borough_name, count(*) AS num_trips
FROM (SELECT CAST(pickup_ts AS DATE) AS assign_date, time_block, "month", "day", borough_name FROM zone_trips
      UNION ALL SELECT assign_date, time_block, "month", "day", borough_name FROM gps_trips)
GROUP BY ALL""",

    "trip_counts": _with(*_ZONE_CHAIN, COUNTS) + "SELECT * FROM counts",

    "historical_mean": _with(*_ZONE_CHAIN, COUNTS, STATS) + "SELECT * FROM stats",

    "demand_stdev": _with(*_ZONE_CHAIN, COUNTS) + """SELECT time_block, "day", "month", borough_name,
       CAST(CASE WHEN count(num_trips) > 1 THEN round(sqrt(
         (count(num_trips) * sum(num_trips * num_trips) - sum(num_trips) * sum(num_trips))
         / (count(num_trips) * (count(num_trips) - 1)))) ELSE 0 END AS DOUBLE) AS stdev
FROM counts GROUP BY time_block, "day", "month", borough_name""",

    "demand_rounded_mean": _with(*_ZONE_CHAIN, COUNTS) + """SELECT time_block, "day", "month", borough_name,
       CAST(CASE WHEN count(num_trips) > 1 THEN round(avg(num_trips)) ELSE min(num_trips) END AS DOUBLE) AS rounded_mean
FROM counts GROUP BY time_block, "day", "month", borough_name""",

    "stats_for_day": _with(*_ZONE_CHAIN, COUNTS, STATS)
    + """SELECT time_block, borough_name, mean FROM stats WHERE "day" = 'Thursday' AND "month" = 'January'""",

    "historical_profile": _with(*_ZONE_CHAIN, COUNTS, STATS) + f"""SELECT {LABEL} AS label, mean FROM stats
WHERE "day" = 'Thursday' AND "month" = 'January' AND borough_name = 'AMERICA'""",

    "live_trips": _with(*_ZONE_CHAIN) + """SELECT CAST(pickup_ts AS DATE) AS assign_date, pickup_ts, time_block, "month", "day", borough_name
FROM zone_trips""",

    "live_counts": _with(*_ZONE_CHAIN) + """SELECT borough_name, time_block, "month", "day",
       min(CAST(pickup_ts AS DATE)) AS assign_date, count(*) AS actual_trips
FROM zone_trips GROUP BY borough_name, time_block, "month", "day\"""",

    "live_vs_history": _with(*_ZONE_CHAIN, COUNTS, STATS, LIVE) + "SELECT * FROM live_stats",

    "live_profile": _with(*_ZONE_CHAIN, COUNTS, STATS, LIVE) + f"""SELECT {LABEL} AS label, mean,
       CAST(sum(actual_trips) AS BIGINT) AS actual_trips
FROM live_stats WHERE borough_name = 'AMERICA' AND mean IS NOT NULL GROUP BY time_block, mean""",

    "overlay_report": _with(*_ZONE_CHAIN, COUNTS, STATS, LIVE) + f"""SELECT {LABEL} AS label, actual_trips, mean FROM (
  SELECT coalesce(h.time_block, l.time_block) AS time_block, l.actual_trips, h.mean
  FROM (SELECT time_block, mean FROM stats
        WHERE "day" = 'Thursday' AND "month" = 'January' AND borough_name = 'AMERICA') h
  FULL OUTER JOIN (SELECT time_block, CAST(sum(actual_trips) AS BIGINT) AS actual_trips FROM live_stats
                   WHERE borough_name = 'AMERICA' AND mean IS NOT NULL GROUP BY time_block) l
  ON h.time_block = l.time_block)""",

    "trip_scan": _with(BASE, ZONE_LINES) + """SELECT f[1] AS VendorID, f[2] AS tpep_pickup_datetime,
       f[8] AS PULocationID, f[9] AS DOLocationID
FROM (SELECT string_split(value, ',') AS f FROM zone_lines)""",

    "file_schema_kind": """WITH k AS (SELECT greatest(1, CAST(ceil(count(*) / 50000) AS BIGINT)) AS k FROM events),
per AS (SELECT e.event_id % k.k AS p, count(*) + 1 AS n_lines FROM events e, k GROUP BY 1)
SELECT 'yellow_tripdata_zone/part=' || p AS file_name, 'TAXIZONE' AS location_type, n_lines FROM per
UNION ALL SELECT 'yellow_tripdata_gps/part=' || p, 'GPS', n_lines FROM per
UNION ALL SELECT 'yellow_tripdata_blank/part=' || p, CAST(NULL AS VARCHAR), n_lines FROM per""",

    "batch_trip_stats": _with(*_ZONE_CHAIN, GPS_LINES, EDGES, GPS_TRIPS) + """SELECT time_block, "month", "day", borough_name,
       avg(num_trips) AS mean, CAST(trunc(avg(num_trips)) AS INTEGER) AS mean_int
FROM (SELECT assign_date, time_block, "month", "day", borough_name, count(*) AS num_trips
      FROM (SELECT CAST(pickup_ts AS DATE) AS assign_date, time_block, "month", "day", borough_name FROM zone_trips
            UNION ALL SELECT assign_date, time_block, "month", "day", borough_name FROM gps_trips)
      GROUP BY ALL)
GROUP BY time_block, "month", "day", borough_name""",

    "trip_preview_count": _with(*_ZONE_CHAIN)
    + "SELECT least(10, count(*)) AS n_shown, least(10, count(*)) AS n_known FROM zone_trips",

    "zone_lookup_csv": _with(ZONES) + "SELECT zone_code, borough_name FROM zones",

    "two_loads_trip_data": _with(*_ZONE_CHAIN, COUNTS) + "SELECT * FROM counts",

    "two_runs_live": _with(*_ZONE_CHAIN) + """SELECT borough_name, time_block, "month", "day",
       count(*) AS n_trips
FROM zone_trips GROUP BY borough_name, time_block, "month", "day\"""",

    "replay_messages": _with(BASE, ZONE_LINES) + f"""SELECT value, count(*) AS n_messages, count(*) AS n_keys FROM (
  SELECT array_to_string(list_concat([f[1], '2024-02-01 ' || string_split(f[2], ' ')[2]], f[3:9]), ',') AS value
  FROM (SELECT event_id, t, string_split(t, ',') AS f
        FROM (SELECT event_id, regexp_replace(value, '^\\s+|\\s+$', '', 'g') AS t FROM zone_lines))
  WHERE length(t) > 0 AND regexp_matches(f[2], '{_TS}')
    AND try_strptime(f[2], '%Y-%m-%d %H:%M:%S') IS NOT NULL)
GROUP BY value""",
}
