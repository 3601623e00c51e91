"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator key.

Every query reads the shared test tables (or data Spark derives from them)
in full; ``tripdemand.plans.oracle`` holds the DuckDB SQL for each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripdemand.functions.time import block_label
from tripdemand.operators.aggregates import (
    demand_rounded_mean, demand_stdev, historical_mean, live_counts, trip_counts, union_trips,
)
from tripdemand.operators.joins import zone_lookup_join
from tripdemand.operators.parse import parse_gps_trips, parse_zone_trips, with_time_features
from tripdemand.operators.replay import replay_messages
from tripdemand.plans import fixtures as fx
from tripdemand.plans.batch import run_batch
from tripdemand.plans.reports import historical_profile, live_profile, overlay_report
from tripdemand.schemas import AS_CODED_ZONE_FIELD, LIVE_KEYS
from tripdemand.session import fresh_dir
from tripdemand.sources.tables import read_table, stats_for_day, write_trip_data, write_trip_stats
from tripdemand.sources.trip_files import classify_files, paths_by_kind, read_trip_csv
from tripdemand.sources.zones import read_zone_lookup
from tripdemand.streaming.live import day_and_month, start_live

Query = Callable[[SparkSession, str], DataFrame]


def _events(spark, sf):
    return fx.table(spark, sf, "events")


def _zone_trips(spark, sf):
    return parse_zone_trips(fx.zone_lines(_events(spark, sf)), fx.zones(spark, sf))


def _gps_trips(spark, sf):
    return parse_gps_trips(fx.gps_lines(_events(spark, sf)), fx.polygon_index(spark))


def _counts(spark, sf):
    return trip_counts(_zone_trips(spark, sf))


def _history(spark, sf) -> str:
    """Write trip_data and trip_stats of the fixture to a fresh warehouse."""
    wh = fresh_dir(spark, "warehouse")
    write_trip_data(_counts(spark, sf), wh)
    write_trip_stats(historical_mean(read_table(spark, wh, "trip_data")), wh)
    return wh


EVENT_FILES = 4


def _run_live(spark, sf, events: DataFrame, wh: str) -> None:
    """The live job over ``events`` written as several files, one micro-batch a file."""
    src = fresh_dir(spark, "events")
    events.withColumn("part", F.col("event_id") % EVENT_FILES).repartition(EVENT_FILES, "part") \
        .write.partitionBy("part").parquet(src)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = start_live(spark, fx.zone_lines(stream), fx.zones(spark, sf), wh, fx.REFERENCE_DATE,
                   checkpoint=fresh_dir(spark, "checkpoint-live"),
                   trigger={"availableNow": True})
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def _live(spark, sf) -> str:
    """History, then the live job over ``events`` read as a stream of several batches."""
    wh = _history(spark, sf)
    _run_live(spark, sf, _events(spark, sf), wh)
    return wh


def q_parse_zone_trips(spark, sf):
    """Zone-coded lines derived from events, parsed."""
    return _zone_trips(spark, sf)


def q_parse_zone_trips_as_coded(spark, sf):
    """Q1: the zone read from field 5 (RatecodeID), as the original code did."""
    return parse_zone_trips(fx.zone_lines(_events(spark, sf)), fx.zones(spark, sf),
                            zone_field=AS_CODED_ZONE_FIELD)


def q_parse_gps_trips(spark, sf):
    """GPS lines derived from events, parsed and located."""
    return _gps_trips(spark, sf)


def q_time_features(spark, sf):
    """F1-F3 on every event timestamp."""
    ev = _events(spark, sf).select("event_id", F.col("ts").alias("pickup_ts"))
    return with_time_features(ev).select("event_id", "time_block", "month", "day")


def q_block_label(spark, sf):
    """the label of every block that occurs."""
    blocks = with_time_features(_events(spark, sf).select(F.col("ts").alias("pickup_ts")))
    return (blocks.select("time_block").distinct()
            .select("time_block", block_label(F.col("time_block")).alias("label")))


def q_zone_lookup_join(spark, sf):
    """Every event's zone id (event_id % 30) joined to the zone dimension."""
    ev = _events(spark, sf).select(
        "event_id", (F.col("event_id") % fx.ZONE_MOD).cast("string").alias("zone_code"))
    return zone_lookup_join(ev, fx.zones(spark, sf)).select("event_id", "borough_name")


def q_borough_point_join(spark, sf):
    """Every event's point located in the fixture polygons."""
    pts = fx.points(_events(spark, sf))
    return fx.polygon_index(spark).locate(pts, "x", "y").select("event_id", "borough_name")


def q_all_trips_union(spark, sf):
    """O4 + A1: both line kinds as one dataset, counted once."""
    return trip_counts(union_trips(_zone_trips(spark, sf), _gps_trips(spark, sf)))


def q_trip_counts(spark, sf):
    """Trips per (date, block, month, weekday, borough)."""
    return _counts(spark, sf)


def q_trip_preview(spark, sf):
    """Ten parsed trips (rows-only: which ten is not fixed)."""
    return _zone_trips(spark, sf).limit(10)


def q_trip_preview_count(spark, sf):
    """How many trips the preview shows, and how many of those the parser gives."""
    trips = _zone_trips(spark, sf)
    shown = trips.limit(10).withColumn("shown", F.lit(1))
    known = trips.distinct().withColumn("known", F.lit(1))
    return shown.join(known, trips.columns, "left").agg(
        F.count("shown").alias("n_shown"), F.count("known").alias("n_known"))


def q_zone_lookup_csv(spark, sf):
    """The zone dimension read from a CSV written from nation and region."""
    path = fresh_dir(spark, "zone-csv")
    fx.zones(spark, sf).select(
        F.col("zone_code").alias("LocationID"), F.col("borough_name").alias("Borough"),
        F.lit("z").alias("Zone"), F.lit("s").alias("service_zone")) \
        .write.option("header", True).csv(path)
    return read_zone_lookup(spark, path)


def q_two_loads_trip_data(spark, sf):
    """Two loads that share their dates add up; a load written again changes nothing."""
    wh = fresh_dir(spark, "warehouse")
    ev = _events(spark, sf)
    for rest in (0, 1, 0):
        lines = fx.zone_lines(ev.where(F.col("event_id") % 2 == rest))
        write_trip_data(trip_counts(parse_zone_trips(lines, fx.zones(spark, sf))), wh, f"load-{rest}")
    return read_table(spark, wh, "trip_data")


def q_two_runs_live(spark, sf):
    """Two live runs with checkpoints of their own keep all their rows."""
    wh = _history(spark, sf)
    ev = _events(spark, sf)
    for rest in (0, 1):
        _run_live(spark, sf, ev.where(F.col("event_id") % 2 == rest), wh)
    log = read_table(spark, wh, "real_trip")
    return log.groupBy(*LIVE_KEYS).agg(F.count("*").alias("n_trips"))


def q_historical_mean(spark, sf):
    """A2: mean trips per (block, weekday, month, borough)."""
    return historical_mean(_counts(spark, sf))


def q_demand_stdev(spark, sf):
    """A5: rounded sample standard deviation per cell."""
    return demand_stdev(_counts(spark, sf))


def q_demand_rounded_mean(spark, sf):
    """Rounded mean per cell."""
    return demand_rounded_mean(_counts(spark, sf))


def q_stats_for_day(spark, sf):
    """Stored stats of the reference weekday and month."""
    day, month = day_and_month(fx.REFERENCE_DATE)
    return stats_for_day(spark, _history(spark, sf), day, month)


def q_historical_profile(spark, sf):
    """Historical profile of one borough and day."""
    day, month = day_and_month(fx.REFERENCE_DATE)
    stats = read_table(spark, _history(spark, sf), "trip_stats")
    return historical_profile(stats, day, month, fx.REPORT_BOROUGH)


def q_live_trips(spark, sf):
    """The live log after streaming events through the live job in several batches."""
    return read_table(spark, _live(spark, sf), "real_trip").drop("run_id", "batch_id")


def q_live_counts(spark, sf):
    """A3, T5: per-batch live counts recomputed from the stored log, summed over its batches."""
    log = read_table(spark, _live(spark, sf), "real_trip")
    return live_counts(log, extra_keys=["run_id", "batch_id"]).groupBy(*LIVE_KEYS).agg(
        F.min("assign_date").alias("assign_date"), F.sum("actual_trips").alias("actual_trips"))


def q_live_vs_history(spark, sf):
    """Per-batch counts joined with the day's means, summed over the batches."""
    return read_table(spark, _live(spark, sf), "real_trip_stats").groupBy(*LIVE_KEYS, "mean").agg(
        F.min("assign_date").alias("assign_date"), F.sum("actual_trips").alias("actual_trips"))


def q_live_profile(spark, sf):
    """Live profile of one borough."""
    return live_profile(read_table(spark, _live(spark, sf), "real_trip_stats"), fx.REPORT_BOROUGH)


def q_overlay_report(spark, sf):
    """Live and historical series on one time axis."""
    wh = _live(spark, sf)
    day, month = day_and_month(fx.REFERENCE_DATE)
    return overlay_report(read_table(spark, wh, "trip_stats"),
                          read_table(spark, wh, "real_trip_stats"),
                          fx.REPORT_BOROUGH, day, month)


def q_replay_messages(spark, sf):
    """Historical lines as live messages; every message has a key of its own."""
    return replay_messages(fx.zone_lines(_events(spark, sf)), fx.REPLAY_DATE).groupBy("value").agg(
        F.count("*").alias("n_messages"), F.countDistinct("key").alias("n_keys"))


def _write_trip_files(spark, sf, names: tuple = ("zone", "gps", "blank", "green")) -> str:
    """A folder of trip files derived from ``events``: zone-coded files, GPS
    files, files whose first line is blank, and non-trip files."""
    root = fresh_dir(spark, "trip-files")
    ev = _events(spark, sf)
    files = {"zone": ("yellow_tripdata_zone", fx.zone_coded_header(), fx.zone_lines),
             "gps": ("yellow_tripdata_gps", fx.gps_header(), fx.gps_lines),
             "blank": ("yellow_tripdata_blank", "", fx.zone_lines),
             "green": ("green_tripdata_zone", fx.zone_coded_header(), fx.zone_lines)}
    for name in names:
        folder, header, lines = files[name]
        fx.write_trip_files(spark, root, folder, header, lines(ev, keep_id=True))
    return root


def q_file_schema_kind(spark, sf):
    """S2/S3 on a derived folder, plus the line count of each listed file."""
    root = _write_trip_files(spark, sf)
    kinds = classify_files(spark, root)
    lines = (spark.read.text([r.file_path for r in kinds.select("file_path").collect()])
             .groupBy(F.col("_metadata.file_path").alias("_path"))
             .agg(F.count(F.lit(1)).alias("n_lines")))
    return (kinds.join(lines, F.col("_path") == F.col("file_path"))
            .select(F.regexp_extract("file_path", r"([^/]+/part=[0-9]+)/[^/]+$", 1)
                    .alias("file_name"), "location_type", "n_lines"))


def q_trip_scan(spark, sf):
    """Typed CSV scan of the zone-coded files found by S2/S3."""
    root = _write_trip_files(spark, sf, ("zone",))
    kinds = paths_by_kind(classify_files(spark, root))
    return read_trip_csv(spark, kinds["TAXIZONE"], "TAXIZONE").select(
        "VendorID", "tpep_pickup_datetime", "PULocationID", "DOLocationID")


def q_batch_trip_stats(spark, sf):
    """L1 end to end: classify the derived files, parse both kinds, count,
    write trip_data, read it back, average, write trip_stats; read that."""
    root = _write_trip_files(spark, sf, ("zone", "gps"))
    wh = fresh_dir(spark, "warehouse")
    run_batch(spark, root, wh, zones=fx.zones(spark, sf), index=fx.polygon_index(spark))
    return read_table(spark, wh, "trip_stats")


QUERIES: dict[str, Query] = {
    "trip_scan": q_trip_scan,
    "batch_trip_stats": q_batch_trip_stats,
    "file_schema_kind": q_file_schema_kind,
    "parse_zone_trips": q_parse_zone_trips,
    "parse_zone_trips_as_coded": q_parse_zone_trips_as_coded,
    "parse_gps_trips": q_parse_gps_trips,
    "time_features": q_time_features,
    "block_label": q_block_label,
    "zone_lookup_join": q_zone_lookup_join,
    "borough_point_join": q_borough_point_join,
    "all_trips_union": q_all_trips_union,
    "trip_counts": q_trip_counts,
    "trip_preview": q_trip_preview,
    "trip_preview_count": q_trip_preview_count,
    "zone_lookup_csv": q_zone_lookup_csv,
    "two_loads_trip_data": q_two_loads_trip_data,
    "two_runs_live": q_two_runs_live,
    "historical_mean": q_historical_mean,
    "demand_stdev": q_demand_stdev,
    "demand_rounded_mean": q_demand_rounded_mean,
    "stats_for_day": q_stats_for_day,
    "live_trips": q_live_trips,
    "live_counts": q_live_counts,
    "live_vs_history": q_live_vs_history,
    "historical_profile": q_historical_profile,
    "live_profile": q_live_profile,
    "overlay_report": q_overlay_report,
    "replay_messages": q_replay_messages,
}
