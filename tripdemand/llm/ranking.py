"""Positions in a sorted group without putting the group into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripdemand.llm.common import materialize


def ranked(df: DataFrame, group: str, order: list[str], rank: str = "rank", size: str = "size") -> DataFrame:
    """``df`` with the position (from 0) of each row in its ``group`` by ``order``, and the group's size.

    Rows are range-partitioned by group and order, nulls first, so a group of a third of all rows
    spans many partitions; equal rows are spread by their place in the input. Each row is numbered
    inside its partition, and the counts of a group's earlier partitions are added: that table has
    one row per partition and group in it. ``df`` should be a written table (it is read twice, to
    sample the ranges and to sort).
    """
    sort = [group, *order, "_place"]
    placed = df.withColumn("_place", F.monotonically_increasing_id())
    rows = materialize(placed.repartitionByRange(*sort).sortWithinPartitions(*sort).drop("_place")
                       .withColumn("_at", F.monotonically_increasing_id()), "ranked")
    # The id's upper bits are the partition, the lower 33 the row in it.
    part = F.shiftright("_at", 33)
    blocks = rows.groupBy(group, part.alias("_part")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(group)
    blocks = blocks.select(
        F.col(group).alias("_group"), "_part", "_first", F.sum("_n").over(w).alias(size),
        F.coalesce(F.sum("_n").over(w.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return (rows.withColumn("_part", part).join(blocks, "_part")
            .where(F.col(group).eqNullSafe(F.col("_group")))
            .withColumn(rank, F.col("_before") + F.col("_at") - F.col("_first"))
            .drop("_part", "_group", "_at", "_first", "_before"))
