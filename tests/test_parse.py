"""Literal-row tests of the parsing quirks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import lines_df
from tripdemand.functions.text import float_value, is_int_text, tokens
from tripdemand.functions.time import block_label, parse_pickup, time_block
from tripdemand.operators.parse import (
    gps_trip_fields, parse_zone_trips, with_time_features, zone_trip_fields,
)
from tripdemand.schemas import AS_CODED_ZONE_FIELD


def zone_line(pickup="2017-07-06 08:15:30", ratecode="1", zone="5", extra=",7"):
    return f"2,{pickup},{pickup},1,1.0,{ratecode},N,{zone}{extra}"


@pytest.fixture(scope="module")
def zones(spark):
    return spark.createDataFrame(
        [("1", "EWR"), ("5", "Staten Island"), ("264", "Unknown"), ("4", "Manhattan")],
        "zone_code string, borough_name string")


def test_tokens_keep_trailing_empty_fields(spark):
    row = spark.range(1).select(tokens(F.lit("a,b,, \t\r")).alias("t")).first()
    assert row.t == ["a", "b", "", ""]


@pytest.mark.parametrize("text,ok", [
    ("5", True), (" 5 ", True), ("05", True), ("+5", True), ("-5", True),
    ("5.0", False), ("", False), ("zz", False), ("5a", False), (None, False)])
def test_is_int_text(spark, text, ok):
    v = spark.createDataFrame([(text,)], "v string").select(is_int_text(F.col("v"))).first()[0]
    assert v is ok


@pytest.mark.parametrize("text,value", [
    ("1.5", 1.5), (" -73.9 ", -73.9), ("1e3", 1000.0), (".5", 0.5), ("1.", 1.0),
    ("inf", float("inf")), ("-Infinity", float("-inf")), ("1d", None), ("0x1p3", None),
    ("", None), ("abc", None)])
def test_float_value_matches_python_float(spark, text, value):
    v = spark.createDataFrame([(text,)], "v string").select(float_value(F.col("v"))).first()[0]
    assert v == value


def test_float_value_nan(spark):
    v = spark.createDataFrame([("nan",)], "v string").select(float_value(F.col("v"))).first()[0]
    assert v != v


@pytest.mark.parametrize("text,expected", [
    ("2017-07-06 08:15:30", dt.datetime(2017, 7, 6, 8, 15, 30)),
    ("2013-1-5 1:2:3", dt.datetime(2013, 1, 5, 1, 2, 3)),
    ("2013-01-05  01:02:03", dt.datetime(2013, 1, 5, 1, 2, 3)),
    ("2013-02-30 01:02:03", None), ("2013-01-05 24:00:00", None),
    ("2013-01-05 01:02:60", None), ("2013-01-05 01:02", None),
    ("2013-01-05T01:02:03", None), ("13-01-05 01:02:03", None), ("garbage", None)])
def test_parse_pickup(spark, text, expected):
    v = spark.createDataFrame([(text,)], "v string").select(parse_pickup(F.col("v"))).first()[0]
    assert v == expected


def test_time_block_edges_and_names(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 4, 0, 0, 0),), (dt.datetime(2024, 1, 4, 0, 9, 59),),
         (dt.datetime(2024, 1, 4, 23, 59, 59),), (dt.datetime(2017, 7, 6, 12, 10, 0),)],
        "pickup_ts timestamp_ntz")
    rows = with_time_features(df).collect()
    assert [r.time_block for r in rows] == [0, 0, 143, 73]
    assert [r.day for r in rows] == ["Thursday", "Thursday", "Thursday", "Thursday"]
    assert [r.month for r in rows] == ["January", "January", "January", "July"]


def test_block_label(spark):
    rows = spark.createDataFrame([(0,), (1,), (73,), (143,)], "b int").select(
        block_label(F.col("b")).alias("l")).collect()
    assert [r.l for r in rows] == ["00:00", "00:10", "12:10", "23:50"]


def test_zone_parse_drops_bad_lines(spark, zones):
    lines = [
        zone_line(),                          # valid, zone 5
        zone_line(zone="4") + "   \t",        # trailing blanks stripped
        "2,2017-07-06 08:15:30,x",            # short line
        zone_line(zone="zz"),                 # non-integer zone
        zone_line(zone="05"),                 # passes isInt, misses the lookup
        zone_line(zone=" 5"),                 # same
        zone_line(zone="99"),                 # unknown zone
        zone_line(zone="264"),                # Unknown borough is kept
        "VendorID,tpep_pickup_datetime,x,x,x,RatecodeID,x,PULocationID,x",  # stray header
    ]
    out = parse_zone_trips(lines_df(spark, lines), zones).collect()
    assert sorted(r.borough_name for r in out) == ["Manhattan", "Staten Island", "Unknown"]
    r = [r for r in out if r.borough_name == "Staten Island"][0]
    assert (r.time_block, r.month, r.day) == (49, "July", "Thursday")
    assert r.pickup_ts == dt.datetime(2017, 7, 6, 8, 15, 30)


def test_zone_field_as_coded(spark, zones):
    # The as-coded parser reads field 5 (RatecodeID) as the zone.
    lines = [zone_line(ratecode="1", zone="5")]
    doc = parse_zone_trips(lines_df(spark, lines), zones).first()
    coded = parse_zone_trips(lines_df(spark, lines), zones, zone_field=AS_CODED_ZONE_FIELD).first()
    assert doc.borough_name == "Staten Island" and coded.borough_name == "EWR"


def test_seven_field_line_is_enough_for_the_as_coded_field(spark, zones):
    line = "2,2017-07-06 08:15:30,x,1,1.0,5,N"
    assert zone_trip_fields(lines_df(spark, [line]), zone_field=5).count() == 1
    assert zone_trip_fields(lines_df(spark, [line])).count() == 0


def test_bad_timestamp_drop_and_fail(spark, zones):
    lines = [zone_line(), zone_line(pickup="2017-13-01 00:00:00")]
    assert parse_zone_trips(lines_df(spark, lines), zones).count() == 1
    with pytest.raises(Exception, match="malformed pickup timestamp"):
        parse_zone_trips(lines_df(spark, lines), zones, on_bad_timestamp="fail").collect()
    # A bad timestamp on a line dropped for another reason does not fail.
    ok = [zone_line(), zone_line(pickup="bad", zone="zz")]
    assert parse_zone_trips(lines_df(spark, ok), zones, on_bad_timestamp="fail").count() == 1


def gps_line(lon="-73.97", lat="40.76", pickup="2013-01-05 01:02:03"):
    return f"CMT,{pickup},{pickup},1,1.0,{lon},{lat},1,N,-73.9,40.7,CSH,5,0.5,0.5,0,0,6"


def test_gps_fields(spark):
    lines = [gps_line(), gps_line(lon="0"), gps_line(lat="0.0"), gps_line(lon="x"),
             gps_line(lon="nan"), gps_line(lat=" 40.5 "), "a,b,c", gps_line(pickup="bad")]
    rows = gps_trip_fields(lines_df(spark, lines)).collect()
    assert len(rows) == 3
    assert rows[0].lon == -73.97 and rows[0].lat == 40.76
    assert rows[1].lon != rows[1].lon  # NaN passes, as float('nan') does
    assert rows[2].lat == 40.5


def test_time_block_custom_minutes(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 44, 0),)], "t timestamp_ntz")
    assert df.select(time_block(F.col("t"), 15)).first()[0] == 42
