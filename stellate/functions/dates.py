"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_col

EPOCH_1960 = "1960-01-01"


def epoch_days_to_date(c: Column | str, base: str = EPOCH_1960, null_as: int | None = None) -> Column:
    """Day number counted from ``base`` -> date.

    Text such as ``20574.0`` counts as a number; what is no number gives null. A null stays null unless ``null_as`` gives
    the day number to put in its place.
    """
    days = as_col(c).try_cast("double").try_cast("int")
    if null_as is not None:
        days = F.coalesce(days, F.lit(null_as))
    return F.date_add(F.lit(base).cast("date"), days)


def to_date_part(c: Column | str) -> Column:
    """Date part of a timestamp, or of text such as ``2013-09-01 00:00:00``; bad text gives null."""
    return F.substring_index(as_col(c).cast("string"), " ", 1).try_cast("date")


def date_parts(c: Column | str) -> dict[str, Column]:
    """Day of month, day of week (Sunday = 1) and ISO week, keyed by column name."""
    c = as_col(c)
    return {
        "day_of_month": F.dayofmonth(c),
        "day_of_week": F.dayofweek(c),
        "week_of_year": F.weekofyear(c),
    }


def season(month: Column | str) -> Column:
    """Northern meteorological season of a month number."""
    m = as_col(month)
    return (
        F.when(m.isin(12, 1, 2), "winter")
        .when(m.isin(3, 4, 5), "spring")
        .when(m.isin(6, 7, 8), "summer")
        .when(m.isin(9, 10, 11), "autumn")
    )
