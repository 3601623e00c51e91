"""A1-A6 on literal rows: Python 2 statistics semantics."""

import datetime as dt

from tripdemand.operators.aggregates import (
    demand_rounded_mean, demand_stdev, historical_mean, live_counts, summed_live, trip_counts,
)
from tripdemand.plans.reports import historical_profile


def cube(spark, values):
    rows = [(dt.date(2024, 1, i + 1), 5, "January", "Monday", "Queens", v)
            for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "assign_date date, time_block int, month string, "
                                       "day string, borough_name string, num_trips long")


def one(df, col):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0][col]


def test_stdev_rules(spark):
    assert one(demand_stdev(cube(spark, [7])), "stdev") == 0.0          # single value -> 0
    assert one(demand_stdev(cube(spark, [1, 1, 1, 2])), "stdev") == 1.0  # exactly 0.5 -> 1
    assert one(demand_stdev(cube(spark, [1, 2])), "stdev") == 1.0        # 0.707 -> 1
    assert one(demand_stdev(cube(spark, [3, 3, 3])), "stdev") == 0.0
    assert one(demand_stdev(cube(spark, [1, 5, 9])), "stdev") == 4.0


def test_rounded_mean_rules(spark):
    assert one(demand_rounded_mean(cube(spark, [7])), "rounded_mean") == 7.0
    assert one(demand_rounded_mean(cube(spark, [2, 3])), "rounded_mean") == 3.0  # 2.5 -> 3
    assert one(demand_rounded_mean(cube(spark, [1, 2])), "rounded_mean") == 2.0  # 1.5 -> 2
    assert one(demand_rounded_mean(cube(spark, [1, 1, 2])), "rounded_mean") == 1.0


def test_mean_and_truncated_int(spark):
    row = historical_mean(cube(spark, [2, 3, 4, 2])).first()
    assert row.mean == 2.75 and row.mean_int == 2


def test_counts_and_live_counts(spark):
    trips = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 0, 1), 0, "January", "Monday", "Q"),
         (dt.datetime(2024, 1, 1, 0, 2), 0, "January", "Monday", "Q"),
         (dt.datetime(2024, 1, 8, 0, 3), 0, "January", "Monday", "Q")],
        "pickup_ts timestamp_ntz, time_block int, month string, day string, borough_name string")
    assert sorted(r.num_trips for r in trip_counts(trips).collect()) == [1, 2]
    live = live_counts(trips).collect()
    assert len(live) == 1 and live[0].actual_trips == 3 and live[0].assign_date == dt.date(2024, 1, 1)


def test_summed_live_drops_null_means(spark):
    rts = spark.createDataFrame([(1, 2.0, 3), (1, 2.0, 4), (2, None, 5)],
                                "time_block int, mean double, actual_trips long")
    rows = summed_live(rts).collect()
    assert [(r.time_block, r.actual_trips) for r in rows] == [(1, 7)]


def test_profile_empty_without_history(spark):
    stats = spark.createDataFrame([], "time_block int, month string, day string, "
                                      "borough_name string, mean double, mean_int int")
    assert historical_profile(stats, "Monday", "July", "Queens").count() == 0
