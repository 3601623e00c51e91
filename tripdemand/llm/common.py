"""Shared pieces: tables written to the shared folder, connected components."""

from __future__ import annotations

import gc
import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripdemand.session import context, fresh_dir, scratch_root


#: Rows of an Arrow batch to Python where the session has Spark's default (10,000): texts may be long.
ARROW_ROWS = "2000"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table; sees to it that tasks hand long texts to Python in smaller batches."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read again: cuts the lineage.

    A lost executor costs a re-read of the written files, not a re-run.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Collects the driver's garbage: files of shuffles that no plan holds any more go with it, and else stay until it happens."""
    sc = context(spark)
    if sc is not None:
        gc.collect()
        sc._jvm.System.gc()


def discard(table: DataFrame) -> None:
    """Deletes the folder of ``table``, a result of ``materialize`` that nothing will read again, and frees shuffles.

    Uses the session's JVM; on Spark Connect the folder stays.
    """
    sc = context(table.sparkSession)
    if sc is None:
        return
    root = scratch_root(table.sparkSession)
    for folder in {posixpath.dirname(f) for f in table.inputFiles()}:
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        if posixpath.basename(posixpath.dirname(folder)) == posixpath.basename(root):  # folders of this session's scratch only
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
    free_shuffles(table.sparkSession)


def reliable_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir`` (a local one only in tests)."""
    return scratch_root(spark)


def ids_as_text(df: DataFrame, column: str) -> DataFrame:
    """``df`` with an id as text, for Python code that only hands ids on: pandas would turn 64-bit ids beside a null into floats."""
    return df.withColumn(column, F.col(column).cast("string"))


def ids_back(df: DataFrame, column: str, like: DataFrame) -> DataFrame:
    """``df`` with the id in the type it has in ``like`` again."""
    return df.withColumn(column, F.col(column).cast(like.schema[column].dataType))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of ``edges``; component is its smallest node.

    Each round every node with a smaller neighbour is hooked below its
    smallest one, paths are shortened once, and the edges are contracted to the
    labels reached, so they vanish after a logarithmic number of rounds. All
    state stays in tables of the shared folder: nothing is collected but the
    edge count. Every shuffle before a join can be split by key (a star's
    centre is one row per edge, never one group in a task); the minima are
    partial aggregates.
    """
    live = materialize(
        edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
        .where("a is not null and b is not null and a < b").distinct(), "cc-edges")
    labels = None
    while True:
        both = live.union(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = materialize(both.groupBy(F.col("a").alias("node"))
                           .agg(F.least(F.col("node"), F.min("b")).alias("up")), "cc-hook")
        if labels is not None and hook.isEmpty():
            return labels
        twice = hook.alias("h").join(hook.alias("g"), F.col("h.up") == F.col("g.node"), "left") \
            .select(F.col("h.node").alias("node"), F.coalesce("g.up", "h.up").alias("up"))
        step = materialize(twice, "cc-step")
        if labels is None:
            labels = step.select("node", F.col("up").alias("component"))
        else:
            labels = materialize(
                labels.join(step.select(F.col("node").alias("component"), "up"), "component", "left")
                .select("node", F.coalesce("up", "component").alias("component")), "cc-labels")
        if hook.isEmpty():
            return labels
        sa = step.select(F.col("node").alias("a"), F.col("up").alias("ua"))
        sb = step.select(F.col("node").alias("b"), F.col("up").alias("ub"))
        live = materialize(
            live.join(sa, "a").join(sb, "b").where("ua <> ub")
            .select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct(), "cc-edges")


def bounded_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """``df`` (a written table) hinted for broadcast if it has at most ``rows`` rows; else ``df`` itself."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
