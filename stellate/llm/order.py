"""A total order of all rows over ordinary tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TIE = "_tie"


def sorted_by(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Rows in ascending order of ``keys`` from partition to partition and within each; nulls come first.

    Rows with equal keys, be they a third of the table, are split among partitions by a number that the scan gives them.
    """
    out = df.withColumn(TIE, F.monotonically_increasing_id())
    return out.repartitionByRange(*keys, TIE).sortWithinPartitions(*keys, TIE).drop(TIE)


def running_start(df: DataFrame, group: str, within: str, size: str, name: str) -> DataFrame:
    """``name`` := sum of ``size`` over all earlier rows in the order of (``group``, ``within``).

    For small tables such as the list of a job's partitions or files: one row per group meets in one task, the rest is
    summed group by group.
    """
    from pyspark.sql import Window

    totals = df.groupBy(group).agg(F.sum(size).alias("_total"))
    before = Window.orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(group, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base"))
    own = Window.partitionBy(group).orderBy(within).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.withColumn("_own", F.coalesce(F.sum(size).over(own), F.lit(0)))
        .join(starts, group)
        .withColumn(name, F.col("_base") + F.col("_own"))
        .drop("_base", "_own")
    )
