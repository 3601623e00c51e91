"""The stored tables as SQL views, and the original's three parameterized
table reads as Spark SQL statements (named parameter markers).

    register_views(spark, warehouse)
    run_statement(spark, "stats_for_report", day="Thursday", month="July",
                  borough="Queens")
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripdemand.sources.tables import TABLE_SCHEMAS, read_table

# The original's statements, with the same columns and filters.
STATEMENTS = {
    # stats of one weekday and month, read once when the live job starts
    "stats_for_day": "SELECT time_block, borough_name, mean FROM trip_stats "
                     "WHERE day = :day AND month = :month",
    # historical profile of one borough
    "stats_for_report": "SELECT time_block, mean FROM trip_stats "
                        "WHERE day = :day AND month = :month AND borough_name = :borough",
    # live rows of one borough
    "live_for_report": "SELECT time_block, mean, actual_trips FROM real_trip_stats "
                       "WHERE borough_name = :borough",
}


def register_views(spark: SparkSession, warehouse: str, prefix: str = "") -> list[str]:
    """Temp views ``trip_data``, ``trip_stats``, ``real_trip``, ``real_trip_stats``
    over the warehouse folders that exist; returns the registered names."""
    from pyspark.errors import AnalysisException
    names = []
    for name in TABLE_SCHEMAS:
        try:
            df = read_table(spark, warehouse, name)
        except AnalysisException:  # table not written yet
            continue
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names


def run_statement(spark: SparkSession, name: str, **params) -> DataFrame:
    """Run one of :data:`STATEMENTS` with its named parameters bound by Spark."""
    return spark.sql(STATEMENTS[name], args=params)
