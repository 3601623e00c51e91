"""The SQL views and parameterized statements equal the DataFrame reports."""

from pyspark.sql import functions as F

from tests.conftest import SF0001
from tripdemand.plans import registry
from tripdemand.plans.sql import register_views, run_statement
from tripdemand.sources.tables import read_table, stats_for_day


def test_statements_match_dataframe_reads(spark):
    wh = registry._live(spark, SF0001)
    assert set(register_views(spark, wh)) == {"trip_data", "trip_stats", "real_trip",
                                              "real_trip_stats"}
    a = run_statement(spark, "stats_for_day", day="Thursday", month="January")
    b = stats_for_day(spark, wh, "Thursday", "January")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect())) and a.count() > 0

    r = run_statement(spark, "stats_for_report", day="Thursday", month="January",
                      borough="AMERICA").collect()
    stats = read_table(spark, wh, "trip_stats").where(
        (F.col("day") == "Thursday") & (F.col("month") == "January")
        & (F.col("borough_name") == "AMERICA"))
    assert sorted(tuple(x) for x in r) == sorted(map(tuple, stats.select("time_block", "mean").collect()))

    live = run_statement(spark, "live_for_report", borough="AMERICA")
    assert live.columns == ["time_block", "mean", "actual_trips"] and live.count() > 0
