"""Counts, duplicate removal, ranking and union."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Order = Sequence[Column | str]


def profile(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column with its number of nulls, from one pass over the table."""
    names = df.columns
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in names])
    return counts.unpivot([], [F.col(f"`{c}`") for c in names], "column_name", "null_count")


def dedupe(df: DataFrame) -> DataFrame:
    """Remove rows that repeat in all columns. Copies collapse inside each task before the shuffle."""
    return df.dropDuplicates()


def top_per_group(df: DataFrame, group: Sequence[str], order: Order, n: int = 1, rank: str | None = None) -> DataFrame:
    """First ``n`` rows of each group in the given order, which should end in a tie-break.

    Spark cuts every group to ``n`` rows inside each task before it shuffles (``WindowGroupLimit`` in the plan), so a
    group with a third of all rows sends ``n`` rows per task.
    """
    position = rank or "__position"
    w = Window.partitionBy(*group).orderBy(*order)
    top = df.withColumn(position, F.row_number().over(w)).where(F.col(position) <= n)
    return top if rank else top.drop(position)


def dedupe_by_key(df: DataFrame, key: Sequence[str], order_by: Order) -> DataFrame:
    """One row per key: the first in ``order_by``. The order is mandatory so that the survivor is repeatable."""
    if not order_by:
        raise ValueError("dedupe_by_key needs an order")
    return top_per_group(df, key, order_by)


def one_per_key(df: DataFrame, key: Sequence[str], order_by: Order) -> DataFrame:
    """One row per key, the first in ``order_by``; a row with a null in its key repeats only rows that agree with it in
    every column (but those whose names begin with two underscores)."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    others = [c for c in df.columns if c not in key and not c.startswith("__")]
    guarded = df.withColumn("__whole", F.when(missing, F.struct(F.lit(0), *others)))
    return dedupe_by_key(guarded, [*key, "__whole"], order_by).drop("__whole")


def count_by(df: DataFrame, keys: Mapping[str, Column] | Sequence[str], count: str = "n") -> DataFrame:
    """Rows per key. ``keys`` are column names, or new names with their expressions."""
    cols = [c.alias(k) for k, c in keys.items()] if isinstance(keys, Mapping) else list(keys)
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(count))


def peak(df: DataFrame, keys: Mapping[str, Column] | Sequence[str], count: str = "n") -> DataFrame:
    """The key with the most rows; the smallest key wins a tie."""
    return count_by(df, keys, count).orderBy(F.desc(count), *[F.asc(k) for k in keys]).limit(1)


def first_rows(df: DataFrame, n: int, order_by: Order | None = None) -> DataFrame:
    """First n rows, for display. With an order this keeps n rows per task and never sorts the table."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def union_all(*dfs: DataFrame) -> DataFrame:
    """Rows of all frames, columns matched by name."""
    return reduce(DataFrame.unionByName, dfs)
