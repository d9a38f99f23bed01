"""Published geography tables. Each function takes landed frames (sanitised names) and returns the finished table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import to_date_part
from ..functions.geo import parse_hemisphere, split_coordinates
from ..functions.text import split_code_label
from ..operators.aggregates import dedupe
from ..operators.filters import drop_nulls, drop_sentinel
from ..operators.joins import enrich
from ..operators.labels import standardise_labels
from ..operators.shape import rename, select_renamed, strip_and_cast
from . import fixed_values as fixed


def state_boundaries(raw: DataFrame) -> DataFrame:
    """Code, name and centre of each state."""
    return select_renamed(dedupe(raw.select(*fixed.STATE_COLUMNS)), fixed.STATE_COLUMNS)


def city_demographics(raw: DataFrame) -> DataFrame:
    """Population and median age per city; the raw rows per race collapse to one."""
    return drop_nulls(dedupe(raw.select(*fixed.CITY_COLUMNS)))


def iso_codes(raw: DataFrame) -> DataFrame:
    """Country names with their two- and three-letter codes."""
    return select_renamed(raw, fixed.ISO_COLUMNS)


def code_coordinates(raw: DataFrame) -> DataFrame:
    """Country codes with average coordinates; stray blanks and quotes leave the codes and the numbers."""
    codes = strip_and_cast(raw, ["alpha-2_code", "alpha-3_code"])
    return select_renamed(
        strip_and_cast(codes, ["latitude_average", "longitude_average"], type_="double"), fixed.COORDINATE_COLUMNS
    )


def former_countries(raw: DataFrame) -> DataFrame:
    """Retired country name, its current name as given, and the list of successors.

    A cell such as ``[Czechia, Slovakia]`` holds several successors.
    """
    cell = F.col("new_country_names")
    listed = cell.startswith("[")
    successors = F.when(listed, F.split(F.btrim(cell, F.lit("[]")), ", ")).otherwise(F.array(cell))
    return raw.select("former_country_name", "new_country_names", successors.alias("successors"))


def world_reference(iso: DataFrame, coordinates: DataFrame) -> DataFrame:
    """ISO codes joined to the coordinates, with the reference name of each country.

    A three-letter code with two names in the coordinates gives two rows.
    """
    return enrich(
        iso, coordinates, {"iban_iso3": "ccc_iso3"}, prefer={"reference_country": ("ccc_country", "iban_country")}
    )


def country_names(world: DataFrame) -> DataFrame:
    """The reference list: distinct country names."""
    return dedupe(drop_nulls(world.select("reference_country")))


def airports(raw: DataFrame) -> DataFrame:
    """Airports with coordinates as numbers; those without a place are dropped."""
    placed = drop_sentinel(dedupe(rename(raw, fixed.AIRPORT_RENAMES)), "coordinates", fixed.AIRPORT_NO_PLACE)
    latitude, longitude = split_coordinates("coordinates")
    return placed.withColumns({"latitude": latitude, "longitude": longitude}).drop("local_code", "coordinates")


def port_codes(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Port code and location from location-code text."""
    code, label = split_code_label(line_col)
    return dedupe(lines.select(code.alias("us_port_city_code"), label.alias("us_locode_loc")))


def temperatures(raw: DataFrame, names: DataFrame, former: DataFrame) -> DataFrame:
    """Monthly city temperatures under reference country names; months without an average are dropped."""
    measured = drop_nulls(raw, ["averagetemperature"]).select(
        to_date_part("dt").alias("date"),
        "averagetemperature",
        "averagetemperatureuncertainty",
        "city",
        "country",
        parse_hemisphere("latitude").alias("latitude"),
        parse_hemisphere("longitude").alias("longitude"),
    )
    named = standardise_labels(dedupe(measured), "country", "country_iso3166", names, "reference_country", former)
    return named.select(*fixed.TEMPERATURE_COLUMNS)
