"""L1: the historical batch job -- classify files, count, write, average."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripdemand.operators.aggregates import stats_from_moments, trip_counts, union_trips
from tripdemand.operators.parse import parse_gps_trips, parse_zone_trips
from tripdemand.schemas import BLOCK_MINUTES, ZONE_FIELD
from tripdemand.sources.tables import refresh_moments, write_trip_data, write_trip_stats
from tripdemand.sources.trip_files import classify_files, paths_by_kind, read_trip_lines


def count_trips(spark: SparkSession, zone_paths: list[str], gps_paths: list[str],
                zones: DataFrame | None, index, zone_field: int = ZONE_FIELD,
                on_bad_timestamp: str = "drop",
                block_minutes: int = BLOCK_MINUTES) -> DataFrame:
    """Both kinds of files -> one union -> one aggregation (A1 over O4)."""
    parts = []
    if zone_paths:
        parts.append(parse_zone_trips(read_trip_lines(spark, zone_paths), zones,
                                      zone_field=zone_field, on_bad_timestamp=on_bad_timestamp,
                                      block_minutes=block_minutes))
    if gps_paths:
        parts.append(parse_gps_trips(read_trip_lines(spark, gps_paths), index,
                                     on_bad_timestamp=on_bad_timestamp,
                                     block_minutes=block_minutes))
    if not parts:
        raise ValueError("no trip files to process")
    return trip_counts(union_trips(*parts))


def run_batch(spark: SparkSession, input_root: str, warehouse: str,
              zones: DataFrame | None = None, index=None, prefix: str = "yellow",
              zone_field: int = ZONE_FIELD, on_bad_timestamp: str = "drop",
              load: str | None = None) -> dict:
    """List + classify (S2/S3) -> count (A1) -> write trip_data (S9) ->
    refresh the cells' moments (S7, the dates of this load only) -> mean (A2) -> write trip_stats (S10).

    ``load`` names what is loaded (default: the input folder and prefix). A
    second run of a load replaces its rows; different loads add up, also on the
    dates they share, so they must not overlap in files. The means are over
    every stored date, not just this run's: the moments of the other dates come
    from the last state.
    """
    kinds = paths_by_kind(classify_files(spark, input_root, prefix))
    if kinds["TAXIZONE"] and zones is None:
        raise ValueError("zone-coded files need the zone lookup (zones)")
    if kinds["GPS"] and index is None:
        raise ValueError("GPS files need the polygon index (index)")
    counts = count_trips(spark, kinds["TAXIZONE"], kinds["GPS"], zones, index,
                         zone_field=zone_field, on_bad_timestamp=on_bad_timestamp)
    write_trip_data(counts, warehouse, load or f"{input_root.rstrip('/')}/{prefix}")
    write_trip_stats(stats_from_moments(refresh_moments(spark, warehouse)), warehouse)
    return {"files": kinds, "warehouse": warehouse}
