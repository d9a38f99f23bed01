"""Data-quality checks.

A check returns one row ``(table_name, check_name, failed_rows, passed)``. Nothing raises until ``raise_on_failure``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .aggregates import union_all

REPORT_SCHEMA = "table_name string, check_name string, failed_rows bigint, passed boolean"


def any_null(keys: Sequence[str]) -> Column:
    """True where any key column is null."""
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def _result(df: DataFrame, table: str, check: str, failed: str) -> DataFrame:
    return df.select(
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        F.col(failed).cast("bigint").alias("failed_rows"),
        (F.col(failed) == 0).alias("passed"),
    )


def check_not_empty(df: DataFrame, table: str = "") -> DataFrame:
    """Fails (one failed row) on an empty table. Reads one row at most."""
    found = df.limit(1).agg((F.lit(1) - F.count(F.lit(1))).alias("failed"))
    return _result(found, table, "not_empty", "failed")


def check_not_null(df: DataFrame, keys: Sequence[str], table: str = "") -> DataFrame:
    """Rows in which any key column is null."""
    return _result(df.agg(F.count_if(any_null(keys)).alias("failed")), table, "not_null", "failed")


def check_unique(df: DataFrame, keys: Sequence[str], table: str = "") -> DataFrame:
    """Keys that more than one row holds; keys with a null are left to ``check_not_null``."""
    groups = df.where(~any_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return _result(groups.agg(F.count_if(F.col("n") > 1).alias("failed")), table, "unique", "failed")


def key_report(df: DataFrame, keys: Sequence[str], table: str = "") -> DataFrame:
    """The three checks above in one pass: one scan of the key columns and one pre-aggregated shuffle."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    complete = ~any_null(keys)
    counts = groups.agg(
        F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).cast("bigint").alias("not_empty"),
        F.coalesce(F.sum(F.when(~complete, F.col("n"))), F.lit(0)).cast("bigint").alias("not_null"),
        F.count_if(complete & (F.col("n") > 1)).cast("bigint").alias("unique"),
    )
    return _as_report(counts, table, ["not_empty", "not_null", "unique"])


def null_report(df: DataFrame, keys: Sequence[str], table: str = "") -> DataFrame:
    """``not_empty`` and ``not_null`` in one pass without a shuffle of the table."""
    counts = df.agg(
        F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).cast("bigint").alias("not_empty"),
        F.count_if(any_null(keys)).cast("bigint").alias("not_null"),
    )
    return _as_report(counts, table, ["not_empty", "not_null"])


def _as_report(counts: DataFrame, table: str, checks: Sequence[str]) -> DataFrame:
    rows = counts.unpivot([], list(checks), "check_name", "failed_rows")
    return rows.select(
        F.lit(table).alias("table_name"), "check_name", "failed_rows", (F.col("failed_rows") == 0).alias("passed")
    )


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when a Parquet table can be read at the path."""
    try:
        spark.read.parquet(path)
        return True
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def check_exists(spark: SparkSession, path: str, table: str = "") -> DataFrame:
    missing = 0 if table_exists(spark, path) else 1
    return _result(spark.range(1).select(F.lit(missing).alias("failed")), table or path, "exists", "failed")


def run_checks(spec: Mapping[str, tuple[DataFrame, Sequence[str]]], unique: bool = True) -> DataFrame:
    """Report over many tables: ``{table name: (frame, key columns)}``, with or without the uniqueness check."""
    one = key_report if unique else null_report
    return union_all(*[one(df, keys, name) for name, (df, keys) in spec.items()])


def failures(report: DataFrame) -> list[str]:
    """Messages of the failed checks (a report has a few rows per table)."""
    rows = report.where(~F.col("passed")).orderBy("table_name", "check_name").collect()
    return [f"{r.table_name}: check {r.check_name} failed for {r.failed_rows} rows" for r in rows]


def raise_on_failure(report: DataFrame) -> None:
    messages = failures(report)
    if messages:
        raise ValueError("; ".join(messages))


def run_until_failure(
    spark: SparkSession, tables: Iterable[tuple[str, str, Sequence[str]]], unique: bool = False
) -> list[str]:
    """Check published tables ``(name, path, key columns)`` in order and raise at the first that fails."""
    from ..sources.readers import read_table

    done = []
    for name, path, keys in tables:
        raise_on_failure(check_exists(spark, path, name))
        raise_on_failure(run_checks({name: (read_table(spark, path), keys)}, unique))
        done.append(name)
    return done
