"""Streaming sources that yield raw trip messages as ``value STRING``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_trip_stream(spark: SparkSession, servers: str, topic: str,
                      options: dict | None = None) -> DataFrame:
    """Kafka topic -> ``value``; the message key is ignored.

    Needs the Kafka connector on the classpath (not present in the test
    image; the same downstream code runs on file streams there).
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers).option("subscribe", topic)
              .options(**(options or {})))
    return reader.load().select(F.col("value").cast("string").alias("value"))


def text_trip_stream(spark: SparkSession, path: str, glob: str | None = None,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """A folder of text files, one message per line -> ``value``."""
    reader = spark.readStream.format("text")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)
