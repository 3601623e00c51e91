"""The zone lookup dimension (zone code text -> borough name)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripdemand.functions.text import is_int_text
from tripdemand.schemas import ZONE_LOOKUP_SCHEMA


def read_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Load the 4-column zone CSV as ``(zone_code STRING, borough_name STRING)``.

    ``zone_code`` keeps the id text exactly as written: trips match on that
    text, so ``05`` or `` 5`` find no zone, as in the dictionary lookup this
    replaces. When an id repeats, the later row wins. Every line is read
    (a header line, if any, is not an integer id and drops out), so a file
    without a header loses no row.
    """
    raw = (spark.read.schema(ZONE_LOOKUP_SCHEMA).option("header", False)
           .option("mode", "PERMISSIVE").csv(path)
           .withColumn("_pos", F.monotonically_increasing_id()))
    return (raw.where(is_int_text(F.col("LocationID")))
            .groupBy(F.col("LocationID").alias("zone_code"))
            .agg(F.max_by("Borough", "_pos").alias("borough_name")))


def zone_dim_from_frame(df: DataFrame, code_col: str, borough_col: str) -> DataFrame:
    """Any DataFrame with an id and a borough column as the zone dimension."""
    return df.select(F.col(code_col).cast("string").alias("zone_code"),
                     F.col(borough_col).cast("string").alias("borough_name"))
