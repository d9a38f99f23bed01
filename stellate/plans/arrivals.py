"""The arrivals fact, its time dimension, and the reports that read them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_parts, epoch_days_to_date, season
from ..operators.aggregates import count_by, dedupe, peak, top_per_group
from ..operators.joins import attach_reference, map_codes
from ..operators.shape import cast_columns, rename
from . import fixed_values as fixed


def arrivals(
    raw: DataFrame, modes: DataFrame, visas: DataFrame, missing_departure_day: int | None = None, distinct: bool = True
) -> DataFrame:
    """One row per arrival: dates from day numbers, integer keys, mode and visa labels.

    A missing departure stays null; ``missing_departure_day=0`` puts 1960-01-01 there. ``distinct=False`` leaves repeated
    rows to a keyed publish, which removes them anyway.
    """
    rows = raw.select(*fixed.ARRIVAL_COLUMNS)
    rows = dedupe(rows) if distinct else rows
    dated = rows.withColumns(
        {
            "arrival_date": epoch_days_to_date("arrdate"),
            "departure_date": epoch_days_to_date("depdate", null_as=missing_departure_day),
        }
    ).drop("arrdate", "depdate")
    typed = cast_columns(dated, fixed.ARRIVAL_INTEGERS, "int")
    typed = cast_columns(typed, ["i94mode", "i94visa"], "int")
    labelled = map_codes(map_codes(typed, "i94mode", modes, "transport_mode"), "i94visa", visas, "visa_category")
    return rename(labelled.drop("i94mode", "i94visa"), fixed.ARRIVAL_RENAMES)


def time_dimension(fact: DataFrame, date: str = "arrival_date") -> DataFrame:
    """Each date of the fact with its parts. Year and month are those of the fact row."""
    dates = fact.select(F.col(date).alias("date"), "year", "month").distinct()
    return dates.withColumns(date_parts("date"))


def monthly_by_category(fact: DataFrame, category: str, count: str = "visitors") -> DataFrame:
    return count_by(fact, ["year", "month", category], count)


def monthly_by_country(
    fact: DataFrame, countries: DataFrame, key: str, code: str, name: str, count: str = "visitors"
) -> DataFrame:
    """Visitors per month and country name. Counting by code first leaves a few rows per month for the join."""
    coded = count_by(fact.withColumn(key, F.col(key).cast(countries.schema[code].dataType)), ["year", "month", key], "n")
    named = attach_reference(coded, countries, {key: code}, {name: name}, fanout="first", order_by=[name])
    return named.groupBy("year", "month", name).agg(F.sum("n").alias(count))


def by_day_of_week(fact: DataFrame, date: str = "arrival_date", count: str = "visitors") -> DataFrame:
    return count_by(fact, {"day_of_week": date_parts(date)["day_of_week"]}, count)


def favourite_per_group(fact: DataFrame, group: str, choice: str, count: str = "visitors") -> DataFrame:
    """Most frequent choice per group, e.g. state per visitor country; the smaller name wins a tie."""
    return top_per_group(count_by(fact, [group, choice], count), [group], [F.desc(count), F.asc(choice)])


def peak_month(fact: DataFrame, count: str = "visitors") -> DataFrame:
    return peak(fact, ["month"], count)


def peak_season(fact: DataFrame, count: str = "visitors") -> DataFrame:
    return peak(fact, {"season": season("month")}, count)
