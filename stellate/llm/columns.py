"""Column names out of the way of an operator's own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def neutral(df: DataFrame, *used: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with every column but the ``used`` ones under a name of its place, and what selects all columns back under
    their old names from a result that still has them."""
    old = df.columns
    names = [c if c in used and old.index(c) == i else f"_column{i}" for i, c in enumerate(old)]

    def back(result: DataFrame) -> DataFrame:
        return result.select([F.col(n).alias(c) for n, c in zip(names, old)])

    return df.toDF(*names), back
