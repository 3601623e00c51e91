"""Report DataFrames over the stored tables.

Each returns a small, ordered DataFrame; nothing is collected here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripdemand.functions.time import block_label
from tripdemand.operators.aggregates import summed_live
from tripdemand.schemas import BLOCK_MINUTES, MONTHS, WEEKDAYS


def check_domain(day: str, month: str) -> None:
    """Weekday and month must be given, as full English names (boroughs are free;
    ``schemas.REPORT_BOROUGHS`` lists those the report offers)."""
    if day not in WEEKDAYS:
        raise ValueError(f"unknown weekday {day!r}; expected one of {WEEKDAYS}")
    if month not in MONTHS:
        raise ValueError(f"unknown month {month!r}; expected one of {MONTHS}")


def historical_profile(trip_stats: DataFrame, day: str, month: str, borough: str,
                       block_minutes: int = BLOCK_MINUTES) -> DataFrame:
    """R1 (P12, O1, F4): ``(label, mean)`` for one weekday, month and borough,
    ordered by block. Empty when there is no history."""
    check_domain(day, month)
    rows = trip_stats.where((F.col("day") == day) & (F.col("month") == month)
                            & (F.col("borough_name") == borough))
    return (rows.select("time_block", block_label(F.col("time_block"), block_minutes)
                        .alias("label"), "mean")
            .orderBy("time_block").drop("time_block"))


def live_profile(real_trip_stats: DataFrame, borough: str, assign_date=None,
                 block_minutes: int = BLOCK_MINUTES) -> DataFrame:
    """R2 (P13, A4, O2, F4): ``(label, mean, actual_trips)`` for one borough.

    Per-batch deltas are summed per (block, mean); ``assign_date`` optionally
    restricts to one day (the original ignored the date).
    """
    rows = real_trip_stats.where(F.col("borough_name") == borough)
    if assign_date is not None:
        rows = rows.where(F.col("assign_date") == F.lit(assign_date).cast("date"))
    return (summed_live(rows)
            .select("time_block", block_label(F.col("time_block"), block_minutes)
                    .alias("label"), "mean", "actual_trips")
            .orderBy("time_block", "mean").drop("time_block"))


def overlay_report(trip_stats: DataFrame, real_trip_stats: DataFrame, borough: str,
                   day: str, month: str, assign_date=None,
                   block_minutes: int = BLOCK_MINUTES) -> DataFrame:
    """today's trips and the historical mean on one time axis.

    Full outer join on the block: either series may be missing a block.
    """
    check_domain(day, month)
    hist = (trip_stats.where((F.col("day") == day) & (F.col("month") == month)
                             & (F.col("borough_name") == borough))
            .select("time_block", "mean"))
    live = real_trip_stats.where(F.col("borough_name") == borough)
    if assign_date is not None:
        live = live.where(F.col("assign_date") == F.lit(assign_date).cast("date"))
    live = summed_live(live).groupBy("time_block").agg(
        F.sum("actual_trips").cast("long").alias("actual_trips"))
    both = hist.join(live, "time_block", "full_outer")
    return (both.select("time_block", block_label(F.col("time_block"), block_minutes)
                        .alias("label"), "actual_trips", "mean")
            .orderBy("time_block").drop("time_block"))
