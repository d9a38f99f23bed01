"""Coordinate and place-name expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_col, parse_number, part_at


def parse_hemisphere(c: Column | str) -> Column:
    """``57.05N`` -> 57.05 and ``10.33W`` -> -10.33; null, empty or bad text gives null."""
    c = as_col(c)
    sign = F.when(F.right(c, F.lit(1)).isin("S", "W"), F.lit(-1.0)).otherwise(F.lit(1.0))
    return sign * parse_number(F.left(c, F.greatest(F.length(c) - 1, F.lit(0))))


def split_coordinates(c: Column | str, sep: str = ", ") -> tuple[Column, Column]:
    """``"a, b"`` -> (a, b) as doubles: first part latitude, second longitude."""
    return parse_number(part_at(c, sep, 0)), parse_number(part_at(c, sep, 1))


def location_label(
    city: Column | str, country_code: Column | str, region: Column | str, country: Column | str, home: str = "US"
) -> Column:
    """``City, STATE`` in the home country (state = text after the dash of the region code), else ``City, Country``.

    Null when either part is null.
    """
    city, region, country = as_col(city), as_col(region), as_col(country)
    return F.when(
        as_col(country_code) == home, F.concat(city, F.lit(", "), part_at(region, "-", 1))
    ).otherwise(F.concat(city, F.lit(", "), country))
