"""Beyond the broadcast bound the joins shuffle instead, with identical results."""

import contextlib
import io

from pyspark.sql import functions as F

from tests.conftest import SF0001
from tripdemand.operators.joins import broadcast_if_bounded, zone_lookup_join
from tripdemand.operators.spatial import PolygonIndex
from tripdemand.plans import fixtures as fx
from tripdemand.sources.boroughs import geojson_edges, geojson_text_frame


def plan_of(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_broadcast_if_bounded(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        big, small = spark.range(1000), spark.range(10)
        hinted = big.join(broadcast_if_bounded(small, 10), "id")
        plain = big.join(broadcast_if_bounded(small, 9), "id")
        assert "BroadcastHashJoin" in plan_of(hinted)
        assert "BroadcastHashJoin" not in plan_of(plain)
        assert hinted.count() == plain.count() == 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_zone_join_without_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        ev = fx.table(spark, SF0001, "events").select(
            "event_id", (F.col("event_id") % 30).cast("string").alias("zone_code"))
        zones = fx.zones(spark, SF0001)
        shuffled = zone_lookup_join(ev, zones, max_broadcast_rows=0)
        assert "BroadcastHashJoin" not in plan_of(shuffled.select("event_id", "borough_name"))
        broadcast = zone_lookup_join(ev, zones)
        assert sorted(map(tuple, shuffled.select("event_id", "borough_name").collect())) == \
            sorted(map(tuple, broadcast.select("event_id", "borough_name").collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_point_join_without_broadcast(spark):
    edges = geojson_edges(geojson_text_frame(spark, fx.FIXTURE_GEOJSON))
    pts = fx.points(fx.table(spark, SF0001, "events"))
    expect = {r.event_id: r.borough_name
              for r in PolygonIndex(edges).locate(pts, "x", "y").collect()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        big = PolygonIndex(edges, max_broadcast_rows=0)
        located = big.locate(pts, "x", "y")
        top = plan_of(located).split("InMemoryRelation")[0]  # above the cached index tables
        assert "BroadcastHashJoin" not in top and "SortMergeJoin" in top
        got = {r.event_id: r.borough_name for r in located.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert got == expect and len(got) == 1000
