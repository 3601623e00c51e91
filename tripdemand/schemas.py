"""Table schemas, key lists and fixed domains."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the original system's for identical results.
# Raw trip file headers, in file order.
ZONE_CODED_COLUMNS = [
    "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count",
    "trip_distance", "RatecodeID", "store_and_fwd_flag", "PULocationID", "DOLocationID",
    "payment_type", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount",
]
GPS_COLUMNS = [
    "vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance",
    "pickup_longitude", "pickup_latitude", "rate_code", "store_and_fwd_flag",
    "dropoff_longitude", "dropoff_latitude", "payment_type", "fare_amount", "surcharge",
    "mta_tax", "tip_amount", "tolls_amount", "total_amount",
]
# Header token that marks a zone-coded file (checked at field index 7).
ZONE_HEADER_TOKEN = "PULocationID"
# Borough reported for a GPS point that lies in no polygon.
OUTSIDE_BOROUGH = "EWR"
# Report domains: boroughs offered by the report, weekday and month names.
REPORT_BOROUGHS = ("EWR", "Queens", "Bronx", "Brooklyn", "Manhattan", "Staten Island")
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August",
          "September", "October", "November", "December")
# Minutes per time block (144 blocks a day).
BLOCK_MINUTES = 10
# Index of the pickup-location field in a zone-coded line: the documented
# PULocationID column. The original code read index 5 (RatecodeID); pass
# zone_field=AS_CODED_ZONE_FIELD to reproduce that.
ZONE_FIELD = 7
AS_CODED_ZONE_FIELD = 5
# A parsed line needs at least this many comma-separated fields.
MIN_FIELDS = 7
# ---------------------------------------------------------------------------

LOCATION_TYPES = ("TAXIZONE", "GPS")

# Keys of the demand cube.
COUNT_KEYS = ["assign_date", "time_block", "month", "day", "borough_name"]
STATS_KEYS = ["time_block", "day", "month", "borough_name"]
LIVE_KEYS = ["borough_name", "time_block", "month", "day"]


def _struct(fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


ZONE_CODED_SCHEMA = _struct([(c, T.StringType()) for c in ZONE_CODED_COLUMNS])

GPS_SCHEMA = _struct([(c, T.StringType()) for c in GPS_COLUMNS])

ZONE_LOOKUP_SCHEMA = _struct(
    [("LocationID", T.StringType()), ("Borough", T.StringType()),
     ("Zone", T.StringType()), ("service_zone", T.StringType())])

# Stored tables (S14), with full keys.
TRIP_DATA_SCHEMA = _struct(
    [("assign_date", T.DateType()), ("time_block", T.IntegerType()),
     ("month", T.StringType()), ("day", T.StringType()),
     ("borough_name", T.StringType()), ("num_trips", T.LongType())])

TRIP_STATS_SCHEMA = _struct(
    [("time_block", T.IntegerType()), ("month", T.StringType()), ("day", T.StringType()),
     ("borough_name", T.StringType()), ("mean", T.DoubleType()),
     ("mean_int", T.IntegerType())])

REAL_TRIP_SCHEMA = _struct(
    [("run_id", T.StringType()), ("batch_id", T.LongType()), ("assign_date", T.DateType()),
     ("pickup_ts", T.TimestampNTZType()), ("time_block", T.IntegerType()), ("month", T.StringType()), ("day", T.StringType()),
     ("borough_name", T.StringType())])

REAL_TRIP_STATS_SCHEMA = _struct(
    [("run_id", T.StringType()), ("batch_id", T.LongType()), ("assign_date", T.DateType()),
     ("time_block", T.IntegerType()), ("month", T.StringType()), ("day", T.StringType()),
     ("borough_name", T.StringType()), ("actual_trips", T.LongType()),
     ("mean", T.DoubleType()), ("stats_version", T.StringType())])

# Mergeable moments of a cell over its dates: mean, deviation and rounded mean derive from them.
TRIP_MOMENTS_SCHEMA = _struct(
    [("time_block", T.IntegerType()), ("day", T.StringType()), ("month", T.StringType()),
     ("borough_name", T.StringType()), ("n", T.LongType()), ("s1", T.LongType()), ("s2", T.LongType())])

TABLE_KEYS = {
    "trip_data": COUNT_KEYS,
    "trip_stats": STATS_KEYS,
    "real_trip": None,  # a log: every trip is kept
    "real_trip_stats": ["run_id", "batch_id"] + LIVE_KEYS,
}

# GeoJSON feature collection: geometry coordinates are kept as raw JSON text
# because their nesting depth depends on the geometry type.
GEOJSON_SCHEMA = T.StructType([
    T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("properties", T.StructType([
            T.StructField("borough", T.StringType()),
            T.StructField("boroughCode", T.StringType()),
        ])),
        T.StructField("geometry", T.StructType([
            T.StructField("type", T.StringType()),
            T.StructField("coordinates", T.StringType()),
        ])),
    ]))),
])
POLYGON_COORDS = "array<array<array<double>>>"
MULTIPOLYGON_COORDS = "array<array<array<array<double>>>>"
