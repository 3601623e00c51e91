"""The stored tables, as Parquet folders under one root.

A folder of rows is written once, under a name of its own, and counts only
from the moment a record of it is appended to a small log: readers take the
folders named by the log, so they see a load, a version of the statistics or a
micro-batch (both live tables) whole or not at all, and a writer that dies leaves
nothing visible.

* ``trip_data``: a folder per load and generation; loading again makes a new
  generation of that load, and the loads of a date add up when read.
* ``trip_stats``: a folder per version, partitioned by ``month``/``day``, so the
  one-day reads of the live job and the reports prune to a single folder.
* ``trip_moments``: count, sum and sum of squares per cell, a version per refresh
  with the generations it covers: a refresh reads the dates of changed loads only.
* ``real_trip``, ``real_trip_stats``: see ``live_store``.

Keys (``schemas.TABLE_KEYS``) are checked in the written folder before it counts.
``fmt``/``options`` let a deployment point the readers at another connector.
"""

from __future__ import annotations

import hashlib
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripdemand.schemas import (
    COUNT_KEYS, REAL_TRIP_SCHEMA, REAL_TRIP_STATS_SCHEMA, STATS_KEYS, TABLE_KEYS, TRIP_DATA_SCHEMA,
    TRIP_MOMENTS_SCHEMA, TRIP_STATS_SCHEMA,
)

TABLE_SCHEMAS = {
    "trip_data": TRIP_DATA_SCHEMA,
    "trip_stats": TRIP_STATS_SCHEMA,
    "real_trip": REAL_TRIP_SCHEMA,
    "real_trip_stats": REAL_TRIP_STATS_SCHEMA,
}
PARTITION_COLUMNS = {"trip_data": ["assign_date"], "trip_stats": ["month", "day"]}
LOADS_LOG = "load_id string, generation string"
VERSIONS_LOG = "version string"
MOMENTS_LOG = "version string, loads array<struct<load_id:string,generation:string>>"


class DuplicateKey(ValueError):
    """Rows to be stored repeat a key of their table."""


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def conform(df: DataFrame, name: str) -> DataFrame:
    """Project and cast to the table's declared schema, in declared order."""
    schema = TABLE_SCHEMAS[name]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def load_id_of(source: str) -> str:
    """Folder-safe identity of a load: the same source gives the same load."""
    return hashlib.sha256(source.encode()).hexdigest()[:16]


def new_version() -> str:
    """A name for a folder; later ones sort after earlier ones."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def append_log(spark: SparkSession, root: str, log: str, schema: str, row: tuple) -> None:
    """One row in one file: it is there or not."""
    spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(table_path(root, log))


def read_log(spark: SparkSession, root: str, log: str, schema: str) -> list:
    """All rows of a log: one per load, version or batch, never data."""
    try:
        return spark.read.schema(schema).parquet(table_path(root, log)).collect()
    except AnalysisException:  # nothing recorded yet
        return []


def check_keys(rows: DataFrame, name: str) -> None:
    """Fail with an example if a key of the table occurs twice (one partial aggregation)."""
    keys = TABLE_KEYS[name]
    if keys is None:
        return
    twice = rows.groupBy(*keys).count().where("count > 1").first()
    if twice is not None:
        raise DuplicateKey(f"{name}: key {[str(twice[k]) for k in keys]} occurs {twice['count']} times")


def current_stats_version(spark: SparkSession, root: str) -> str:
    """The latest complete version of trip_stats; an error if there is none."""
    done = spark.read.schema(VERSIONS_LOG).parquet(table_path(root, "trip_stats_versions"))
    version = done.agg(F.max("version")).first()[0]
    if version is None:
        raise ValueError(f"no complete trip_stats under {root}")
    return version


def current_loads(spark: SparkSession, root: str) -> dict[str, str]:
    """The generation that counts of every load."""
    out: dict[str, str] = {}
    for r in read_log(spark, root, "trip_data_loads", LOADS_LOG):
        out[r.load_id] = max(r.generation, out.get(r.load_id, ""))
    return out


def read_loads(spark: SparkSession, root: str, loads: dict[str, str]) -> DataFrame:
    """The rows of the given generations, not added up; ``assign_date`` prunes folders."""
    path = table_path(root, "trip_data")
    paths = [f"{path}/load_id={k}/generation={g}" for k, g in sorted(loads.items())]
    if not paths:
        return spark.createDataFrame([], TRIP_DATA_SCHEMA)
    return conform(spark.read.option("basePath", path).schema(TRIP_DATA_SCHEMA).parquet(*paths), "trip_data")


def summed_loads(rows: DataFrame) -> DataFrame:
    return conform(rows.groupBy(*COUNT_KEYS).agg(F.sum("num_trips").alias("num_trips")), "trip_data")


def read_stats_version(spark: SparkSession, root: str, version: str) -> DataFrame:
    return conform(spark.read.schema(TRIP_STATS_SCHEMA).parquet(f"{table_path(root, 'trip_stats')}/version={version}"), "trip_stats")


def read_table(spark: SparkSession, root: str, name: str, fmt: str = "parquet",
               options: dict | None = None) -> DataFrame:
    """Full read of a stored table (schema given, never inferred).

    ``trip_data`` is summed over its loads; ``trip_stats`` is the current version; the live
    tables are those of the committed batches.
    """
    if fmt != "parquet":
        return conform(spark.read.format(fmt).options(**(options or {})).load(), name)
    if name == "trip_stats":
        return read_stats_version(spark, root, current_stats_version(spark, root))
    if name == "trip_data":
        return summed_loads(read_loads(spark, root, current_loads(spark, root)))
    from tripdemand.sources.live_store import read_live
    return read_live(spark, root, name)


def _write(df: DataFrame, path: str, name: str) -> DataFrame:
    """Rows clustered by partition column (one file per folder), with their keys checked; the written table.

    Both tables are aggregates, bounded by dates x blocks x boroughs.
    """
    parts = PARTITION_COLUMNS[name]
    conform(df, name).repartition(*parts).write.partitionBy(*parts).parquet(path)
    rows = conform(df.sparkSession.read.schema(TABLE_SCHEMAS[name]).parquet(path), name)
    check_keys(rows, name)
    return rows


def write_trip_data(counts: DataFrame, root: str, load: str = "all") -> None:
    """The rows of one load (any text that names its source); other loads are kept."""
    load_id, generation = load_id_of(load), new_version()
    _write(counts, f"{table_path(root, 'trip_data')}/load_id={load_id}/generation={generation}", "trip_data")
    append_log(counts.sparkSession, root, "trip_data_loads", LOADS_LOG, (load_id, generation))


def write_trip_stats(stats: DataFrame, root: str) -> str:
    """The statistics as a new version, current once it is complete."""
    version = new_version()
    _write(stats, f"{table_path(root, 'trip_stats')}/version={version}", "trip_stats")
    append_log(stats.sparkSession, root, "trip_stats_versions", VERSIONS_LOG, (version,))
    return version


def moments(trip_data: DataFrame) -> DataFrame:
    """Dates, trips and squared trips per cell: whole numbers, so they add and subtract exactly."""
    x = F.col("num_trips").cast("long")
    return trip_data.groupBy(*STATS_KEYS).agg(F.count(x).alias("n"), F.sum(x).alias("s1"), F.sum(x * x).alias("s2"))


def moments_change(spark: SparkSession, root: str, known: dict[str, str], now: dict[str, str]) -> DataFrame:
    """What the loads that changed add to the moments: their dates after, minus the same dates before.

    A date's trips are summed over loads before they are squared, so the dates that a changed load holds
    (or held) are read from all loads, and no others (the filter is on the folders' column).
    """
    changed = [{k: g for k, g in loads.items() if known.get(k) != now.get(k)} for loads in (known, now)]
    dates = [r[0] for r in read_loads(spark, root, changed[0]).unionByName(read_loads(spark, root, changed[1]))
             .select("assign_date").distinct().collect()]
    touched = F.col("assign_date").isin(dates) if dates else F.lit(False)
    after, before = (moments(summed_loads(read_loads(spark, root, loads).where(touched))) for loads in (now, known))
    return after.unionByName(before.select(*STATS_KEYS, *[(-F.col(c)).alias(c) for c in ("n", "s1", "s2")]))


def refresh_moments(spark: SparkSession, root: str) -> DataFrame:
    """The moments of all current loads, from the last state and the loads that changed since.

    The state names the generations it covers and generations are never rewritten, so a
    job that died between a load and its refresh is caught up by the next one.
    """
    states = sorted(read_log(spark, root, "trip_moments_versions", MOMENTS_LOG), key=lambda r: r.version)
    known = {x.load_id: x.generation for x in states[-1].loads} if states else {}
    now = current_loads(spark, root)
    path = table_path(root, "trip_moments")
    if states and known == now:
        return spark.read.schema(TRIP_MOMENTS_SCHEMA).parquet(f"{path}/version={states[-1].version}")
    rows = moments_change(spark, root, known, now)
    if states:
        rows = rows.unionByName(spark.read.schema(TRIP_MOMENTS_SCHEMA).parquet(f"{path}/version={states[-1].version}"))
    version = new_version()
    rows.groupBy(*STATS_KEYS).agg(*[F.sum(c).alias(c) for c in ("n", "s1", "s2")]).where("n > 0") \
        .write.parquet(f"{path}/version={version}")
    append_log(spark, root, "trip_moments_versions", MOMENTS_LOG, (version, sorted(now.items())))
    return spark.read.schema(TRIP_MOMENTS_SCHEMA).parquet(f"{path}/version={version}")


def stats_for_day(spark: SparkSession, root: str, day: str, month: str,
                  fmt: str = "parquet", options: dict | None = None) -> DataFrame:
    """``(time_block, borough_name, mean)`` of one weekday and month.

    On the Parquet layout the filter prunes to one ``month=/day=`` folder.
    """
    return one_day(read_table(spark, root, "trip_stats", fmt, options), day, month)


def one_day(stats: DataFrame, day: str, month: str) -> DataFrame:
    return (stats.where((F.col("day") == day) & (F.col("month") == month))
            .select("time_block", "borough_name", "mean"))


def kafka_frame(messages: DataFrame) -> DataFrame:
    """``(key, value)`` as binary-compatible strings for ``format('kafka')``."""
    return messages.select(F.col("key").cast("string"), F.col("value").cast("string"))


def write_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Publish messages; needs the Kafka connector on the classpath."""
    (kafka_frame(messages).write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())
