"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_sentinel(df: DataFrame, col: str, value: Any) -> DataFrame:
    """Drop rows that hold the sentinel. Null rows go too, since a null is not known to differ."""
    return df.where(F.col(col) != F.lit(value))


def keep_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNotNull())


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in any of the named columns, or in any column at all."""
    return df.na.drop(how="any", subset=list(subset) if subset is not None else None)


def split_by(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """(rows where the predicate is true, all other rows). Rows where it is null belong to the second half."""
    hit = F.coalesce(predicate, F.lit(False))
    return df.where(hit), df.where(~hit)
