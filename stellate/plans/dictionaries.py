"""Country and port dictionaries of the arrivals fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import location_label
from ..functions.text import label_is
from ..operators.aggregates import dedupe_by_key, union_all
from ..operators.filters import drop_nulls, drop_sentinel, keep_not_null, split_by
from ..operators.joins import attach_reference, lookup_chain
from ..operators.labels import format_location, standardise_labels
from ..sources.readers import parse_dictionary
from . import fixed_values as fixed


def country_dictionary(lines: DataFrame, names: DataFrame, former: DataFrame, world: DataFrame) -> DataFrame:
    """Country code, raw label, reference name, three-letter code and coordinates."""
    codes = parse_dictionary(lines, "i94_cntyl_code", "country_i94", "bigint", strip_label=False)
    named = standardise_labels(codes, "country_i94", "country_iso3166", names, "reference_country", former)
    located = attach_reference(
        named,
        world,
        {"country_iso3166": "reference_country"},
        {"iban_iso3": "country_code_iso3", "ccc_lat": "latitude", "ccc_long": "longitude"},
    )
    return located.select(
        "i94_cntyl_code", "country_i94", "country_iso3166", "country_code_iso3", "latitude", "longitude"
    )


def airport_locations(airports: DataFrame, iso: DataFrame, code: str) -> DataFrame:
    """(code, location label) of airports by one of their codes."""
    named = attach_reference(airports, iso, {"iso2_country": "iban_iso2"}, {"iban_country": "iban_country"})
    label = location_label("municipality", "iso2_country", "iso2_region", "iban_country")
    return drop_sentinel(drop_nulls(named.select(code, label.alias("airport_loc_state"))), code, "0")


def port_dictionary(
    lines: DataFrame,
    airports: DataFrame,
    iso: DataFrame,
    ports: DataFrame,
    names: DataFrame,
    former: DataFrame,
    use_iata: bool = False,
) -> DataFrame:
    """Port code, raw label and formatted location.

    Codes without a usable label take the location from the port list, else from the airport with that gps code (and,
    on request, iata code); those found nowhere are dropped. All others have their label formatted.
    """
    codes = parse_dictionary(lines, "i94_prtl_code", "portloc_state_i94")
    unusable, usable = split_by(codes, label_is("portloc_state_i94", fixed.UNUSABLE_PORT_LABELS))

    sources = [
        (ports, "us_port_city_code", "us_locode_loc"),
        (airport_locations(airports, iso, "gps_code"), "gps_code", "airport_loc_state"),
    ]
    if use_iata:
        sources.append((airport_locations(airports, iso, "iata_code"), "iata_code", "airport_loc_state"))
    one_each = dedupe_by_key(unusable, ["i94_prtl_code"], ["portloc_state_i94"])
    found = keep_not_null(lookup_chain(one_each, "i94_prtl_code", sources, "reference_port_loc"), "reference_port_loc")

    labelled = keep_not_null(usable, "portloc_state_i94")
    formatted = format_location(labelled, "portloc_state_i94", names, "reference_country", former)
    columns = ["i94_prtl_code", "portloc_state_i94", "reference_port_loc"]
    return union_all(formatted.select(*columns), found.select(*columns))


def code_labels(lines: DataFrame, label: str) -> DataFrame:
    """Small code dictionary (transport mode, visa category) as a (code, label) frame."""
    return parse_dictionary(lines, "code", label, "int").select(F.col("code"), F.col(label))
