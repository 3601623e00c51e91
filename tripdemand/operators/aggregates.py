"""The demand cube and its statistics.

All are plain ``groupBy().agg()`` plans: Spark runs a partial (map-side)
aggregate before the shuffle, so a hot key -- one borough holding a third
of all trips -- reaches the reducer as one pre-summed row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripdemand.functions.time import day_name, month_name
from tripdemand.schemas import COUNT_KEYS, LIVE_KEYS, STATS_KEYS


def to_count_rows(trips: DataFrame) -> DataFrame:
    """The five cube keys of a parsed trip (date part of the pickup)."""
    if "assign_date" not in trips.columns:
        trips = trips.withColumn("assign_date", F.to_date("pickup_ts"))
    return trips.select(*COUNT_KEYS)


def trip_counts(trips: DataFrame) -> DataFrame:
    """A1: trips per (date, block, month, weekday, borough).

    Month and weekday are functions of the date, so the aggregation keys are
    the three narrow columns and the names are derived once per group after
    it: column pruning then drops the per-trip name formatting, and the
    shuffle carries only partial counts with narrow keys.
    """
    if "assign_date" not in trips.columns:
        trips = trips.withColumn("assign_date", F.to_date("pickup_ts"))
    counts = (trips.groupBy("assign_date", "time_block", "borough_name")
              .agg(F.count(F.lit(1)).alias("num_trips")))
    return counts.select("assign_date", "time_block", month_name(F.col("assign_date")).alias("month"),
                         day_name(F.col("assign_date")).alias("day"), "borough_name",
                         "num_trips")


def union_trips(*parts: DataFrame) -> DataFrame:
    """Both input schemas as one dataset, before a single aggregation."""
    rows = [to_count_rows(p) for p in parts]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def historical_mean(trip_data: DataFrame) -> DataFrame:
    """A2: mean trips per (block, weekday, month, borough) over the dates that
    have at least one trip; ``mean_int`` truncates, like the stored int column."""
    return (trip_data.groupBy(*STATS_KEYS)
            .agg(F.avg("num_trips").alias("mean"))
            .withColumn("mean_int", F.col("mean").cast("int")))


def demand_stdev(trip_data: DataFrame) -> DataFrame:
    """A5: rounded sample standard deviation per cell, 0 for a single value.

    The variance comes from exact integer moments, (n*sum(x^2) - sum(x)^2) /
    (n*(n-1)), so it matches exact rational arithmetic: a true 0.5 stays
    0.5 and rounds half away from zero to 1. Count and both sums are
    partial aggregates.
    """
    x = F.col("num_trips").cast("long")
    stats = trip_data.groupBy(*STATS_KEYS).agg(
        F.count(x).alias("_n"), F.sum(x).alias("_s1"), F.sum(x * x).alias("_s2"))
    n, s1, s2 = F.col("_n"), F.col("_s1"), F.col("_s2")
    var = (n * s2 - s1 * s1) / (n * (n - 1))
    return stats.select(*STATS_KEYS,
                        F.when(n > 1, F.round(F.sqrt(var))).otherwise(F.lit(0.0))
                        .cast("double").alias("stdev"))


def demand_rounded_mean(trip_data: DataFrame) -> DataFrame:
    """Rounded mean per cell (half away from zero); the value itself for one row."""
    return (trip_data.groupBy(*STATS_KEYS)
            .agg(F.count("num_trips").alias("_n"), F.avg("num_trips").alias("_avg"),
                 F.min("num_trips").alias("_only"))
            .select(*STATS_KEYS,
                    F.when(F.col("_n") > 1, F.round("_avg")).otherwise(F.col("_only"))
                    .cast("double").alias("rounded_mean")))


def live_counts(trips: DataFrame, extra_keys: list[str] | None = None) -> DataFrame:
    """A3: trips per (borough, block, month, weekday) of one micro-batch.

    The date is not a key; the earliest date of the cell is carried.
    ``extra_keys`` (e.g. ``batch_id``) recount a stored log per batch.
    """
    keys = list(extra_keys or []) + LIVE_KEYS
    if "assign_date" not in trips.columns:
        trips = trips.withColumn("assign_date", F.to_date("pickup_ts"))
    return (trips.groupBy(*keys)
            .agg(F.min("assign_date").alias("assign_date"),
                 F.count(F.lit(1)).alias("actual_trips")))


def summed_live(real_trip_stats: DataFrame) -> DataFrame:
    """A4: the per-batch deltas of one borough summed per block; rows without a mean drop out.

    The mean is that of the latest statistics any batch of the block was compared with, so a
    recompute between two batches leaves one row per block. Rows of a source without
    versions are summed per (block, mean).
    """
    if "stats_version" not in real_trip_stats.columns:
        return (real_trip_stats.where(F.col("mean").isNotNull()).groupBy("time_block", "mean")
                .agg(F.sum("actual_trips").cast("long").alias("actual_trips")))
    return (real_trip_stats.where(F.col("mean").isNotNull())
            .groupBy("time_block")
            .agg(F.max_by("mean", F.struct("stats_version", "mean")).alias("mean"), F.sum("actual_trips").cast("long").alias("actual_trips")))


def stats_from_moments(moments: DataFrame) -> DataFrame:
    """A2, A5, A6 of every cell from its number of dates, sum and sum of squares."""
    n, s1, s2 = F.col("n"), F.col("s1"), F.col("s2")
    mean = s1.cast("double") / n
    deviation = F.round(F.sqrt((n * s2 - s1 * s1) / (n * (n - 1))))
    return moments.where(n > 0).select(
        *STATS_KEYS, mean.alias("mean"), mean.cast("int").alias("mean_int"),
        F.when(n > 1, deviation).otherwise(F.lit(0.0)).cast("double").alias("stdev"),
        F.when(n > 1, F.round(mean)).otherwise(s1).cast("double").alias("rounded_mean"))
