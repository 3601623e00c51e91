"""Inputs derived from the shared test tables (see FIXTURES.md section 3).

Trip lines are built from ``events`` with Spark expressions, so every
derived query grows with the table: pickup = ``ts`` to the second, zone =
``event_id % 30``, bad lines injected by fixed residues, GPS points from
``event_id`` residues. The zone lookup is ``nation`` joined to ``region``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripdemand.operators.spatial import PolygonIndex
from tripdemand.session import session_key
from tripdemand.sources.boroughs import geojson_edges, geojson_text_frame
from tripdemand.sources.zones import zone_dim_from_frame

# Fixed values of the fixture (also used verbatim by the oracle SQL).
REFERENCE_DATE = "2024-01-04"   # a Thursday in January, inside the data
REPLAY_DATE = "2024-02-01"
REPORT_BOROUGH = "AMERICA"
ZONE_MOD = 30                   # zone id = event_id % 30; 25..29 match no zone
SHORT_LINE_MOD = 97             # event_id % 97 = 0 -> a 3-field line
BAD_ZONE_MOD = 89               # event_id % 89 = 0 -> zone text 'zz' / longitude 'zz'
ZERO_LAT_MOD = 83               # event_id % 83 = 0 -> GPS latitude '0'
X_MOD, Y_MOD = 211, 197         # point = (k % 211 / 10 + 0.013, k % 197 / 10 + 0.007)
FIXTURE_GEOJSON = (
    '{"type": "FeatureCollection", "features": ['
    '{"type": "Feature", "properties": {"borough": "Manhattan", "boroughCode": 1},'
    ' "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [10, 0], [0, 10], [0, 0]]]}},'
    '{"type": "Feature", "properties": {"borough": "Bronx", "boroughCode": 2},'
    ' "geometry": {"type": "MultiPolygon", "coordinates":'
    ' [[[[10, 10], [20, 10], [20, 20], [10, 20], [10, 10]]]]}}]}'
)


_TABLES: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table (read-only input). The lazy DataFrame is reused within a
    session, so its file listing and footer read happen once."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = session_key(spark) + (path,)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(path)
    return _TABLES[key]


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return zone_dim_from_frame(n.join(r, n.n_regionkey == r.r_regionkey), "n_nationkey", "r_name")


_INDEXES: dict = {}


def polygon_index(spark: SparkSession) -> PolygonIndex:
    """The fixture polygons' index, built once per session (a cached dimension)."""
    key = session_key(spark)
    if key not in _INDEXES:
        _INDEXES[key] = PolygonIndex(geojson_edges(geojson_text_frame(spark, FIXTURE_GEOJSON)))
    return _INDEXES[key]


def _text(c: Column) -> Column:
    return c.cast("string")


def _pickup_text() -> Column:
    return F.date_format("ts", "yyyy-MM-dd HH:mm:ss")


def _decimal_text(k: Column, suffix: str) -> Column:
    """``k / 10`` written with one decimal, then ``suffix`` digits appended."""
    return F.concat(_text((k / 10).cast("long")), F.lit("."), _text(k % 10), F.lit(suffix))


def zone_line(events: DataFrame) -> Column:
    eid = F.col("event_id")
    vendor = _text(F.col("user_id") % 2 + 1)
    pickup = _pickup_text()
    zone = F.when(eid % BAD_ZONE_MOD == 0, F.lit("zz")).otherwise(_text(eid % ZONE_MOD))
    full = F.concat_ws(",", vendor, pickup, pickup, _text(eid % 4 + 1), F.lit("1.0"),
                       F.lit("1"), F.lit("N"), zone, _text(eid % ZONE_MOD))
    short = F.concat_ws(",", vendor, pickup, pickup)
    return F.when(eid % SHORT_LINE_MOD == 0, short).otherwise(full)


def zone_lines(events: DataFrame, keep_id: bool = False) -> DataFrame:
    """Zone-coded raw lines ``(value)``; field 1 = pickup, field 7 = zone id."""
    return events.select(*(["event_id"] if keep_id else []), zone_line(events).alias("value"))


def gps_lines(events: DataFrame, keep_id: bool = False) -> DataFrame:
    """GPS raw lines ``(value)``; field 5 = longitude, field 6 = latitude."""
    eid = F.col("event_id")
    vendor = _text(F.col("user_id") % 2 + 1)
    pickup = _pickup_text()
    lon = F.when(eid % BAD_ZONE_MOD == 0, F.lit("zz")).otherwise(_decimal_text(eid % X_MOD, "13"))
    lat = F.when(eid % ZERO_LAT_MOD == 0, F.lit("0")).otherwise(_decimal_text(eid % Y_MOD, "07"))
    full = F.concat_ws(",", vendor, pickup, pickup, _text(eid % 4 + 1), F.lit("1.0"), lon, lat,
                       F.lit("1"), F.lit("N"), lon, lat, F.lit("CSH"), F.lit("5.0"),
                       F.lit("0.5"), F.lit("0.5"), F.lit("0.0"), F.lit("0.0"), F.lit("6.0"))
    short = F.concat_ws(",", vendor, pickup, pickup)
    return events.select(*(["event_id"] if keep_id else []),
                         F.when(eid % SHORT_LINE_MOD == 0, short).otherwise(full).alias("value"))


def points(events: DataFrame) -> DataFrame:
    """``(event_id, x, y)`` GPS points, off every fixture polygon edge."""
    eid = F.col("event_id")
    return events.select("event_id",
                         ((eid % X_MOD) / 10 + 0.013).alias("x"),
                         ((eid % Y_MOD) / 10 + 0.007).alias("y"))


def zone_coded_header() -> str:
    from tripdemand.schemas import ZONE_CODED_COLUMNS
    return ",".join(ZONE_CODED_COLUMNS)


def gps_header() -> str:
    from tripdemand.schemas import GPS_COLUMNS
    return ",".join(GPS_COLUMNS)


# Fixed value of the fixture: derived trip files hold at most this many lines.
LINES_PER_FILE = 50_000


def write_trip_files(spark: SparkSession, root: str, name: str, header: str,
                     lines: DataFrame) -> None:
    """Write ``lines(event_id, value)`` as trip files under ``root/name``.

    Lines go to ``k = ceil(rows / LINES_PER_FILE)`` files by ``event_id % k``
    (folders ``part=<p>``), each file starting with ``header``. Each file is
    written by one task, so no task holds more than one file's lines.
    """
    n = lines.count()
    k = max(1, -(-n // LINES_PER_FILE))
    body = lines.select((F.col("event_id") % k).alias("part"), F.lit(1).alias("_h"), "value")
    heads = spark.range(k).select(F.col("id").alias("part"), F.lit(0).alias("_h"),
                                  F.lit(header).alias("value"))
    (body.unionByName(heads).repartition("part").sortWithinPartitions("part", "_h")
     .select("part", "value").write.partitionBy("part").text(f"{root}/{name}"))
