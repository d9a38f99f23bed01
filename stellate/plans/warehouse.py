"""The whole job: raw inputs -> published star schema -> checks.

Reference tables are published first and read back, so later steps start from stored tables instead of long lineage.
Facts are published by whole months; inputs already published are skipped; running the job again changes nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.incremental import partitions_of, pending, publish_incremental
from ..operators.joins import star
from ..operators.quality import run_until_failure, table_exists
from ..operators.aggregates import union_all
from ..operators.shape import conform, rejected, sanitise_columns
from ..sources.readers import read_delimited, read_lines, read_table
from ..sources.sinks import land, land_files, load_reference, publish, publish_reference
from ..sources.workspace import store
from . import fixed_values as fixed
from .arrivals import arrivals, time_dimension
from .dictionaries import code_labels, country_dictionary, port_dictionary
from .geography import (
    airports,
    city_demographics,
    code_coordinates,
    country_names,
    former_countries,
    iso_codes,
    port_codes,
    state_boundaries,
    temperatures,
    world_reference,
)

MONTH = ["year", "month"]


@dataclass(frozen=True)
class Inputs:
    """Paths of the raw inputs. ``arrivals`` maps a month label to its file."""

    states: str
    cities: str
    iso_codes: str
    coordinates: str
    former_countries: str
    airports: str
    ports: str
    temperatures: str
    country_lines: str
    port_lines: str
    mode_lines: str
    visa_lines: str
    arrivals: Mapping[str, str] = field(default_factory=dict)


def build_reference(spark: SparkSession, inputs: Inputs, out: str) -> None:
    """Code lists, world reference and the two reference lists."""
    iso = iso_codes(sanitise_columns(read_delimited(spark, inputs.iso_codes)))
    coordinates = code_coordinates(sanitise_columns(read_delimited(spark, inputs.coordinates, escape='"')))
    former = former_countries(sanitise_columns(read_delimited(spark, inputs.former_countries)))
    publish_reference(iso, f"{out}/reference/iso_codes")
    publish_reference(coordinates, f"{out}/reference/code_coordinates")
    publish_reference(former, f"{out}/reference/former_countries")
    world = world_reference(
        load_reference(spark, f"{out}/reference/iso_codes"), load_reference(spark, f"{out}/reference/code_coordinates")
    )
    publish_reference(world, f"{out}/reference/world")
    publish_reference(country_names(load_reference(spark, f"{out}/reference/world")), f"{out}/reference/country_names")


def build_dimensions(spark: SparkSession, inputs: Inputs, out: str) -> None:
    """All dimensions except time."""
    iso = load_reference(spark, f"{out}/reference/iso_codes")
    former = load_reference(spark, f"{out}/reference/former_countries")
    names = load_reference(spark, f"{out}/reference/country_names")
    world = load_reference(spark, f"{out}/reference/world")

    states = state_boundaries(conform(read_delimited(spark, inputs.states, sep=";"), fixed.STATE_TYPES))
    publish(states.hint("rebalance"), f"{out}/state_boundaries")

    raw_cities = sanitise_columns(read_delimited(spark, inputs.cities, sep=";"))
    cities = land(conform(raw_cities, fixed.CITY_TYPES), f"{out}/landed/cities")
    publish(city_demographics(cities).hint("rebalance"), f"{out}/city_demographics", sort_within=["state", "city"])

    fields = land(conform(sanitise_columns(read_delimited(spark, inputs.airports)), fixed.AIRPORT_TYPES), f"{out}/landed/airports")
    publish_reference(airports(fields), f"{out}/reference/airports")
    publish_reference(port_codes(read_lines(spark, inputs.ports)), f"{out}/reference/port_codes")

    measured = land(read_delimited(spark, inputs.temperatures, schema=TEMPERATURE_SCHEMA), f"{out}/landed/temperatures")
    publish(
        temperatures(measured, names, former),
        f"{out}/temperatures",
        partition_by=["country_iso3166"],
        sort_within=["date", "city"],
    )
    publish_reference(
        country_dictionary(read_lines(spark, inputs.country_lines), names, former, world), f"{out}/countries"
    )
    publish_reference(
        port_dictionary(
            read_lines(spark, inputs.port_lines),
            load_reference(spark, f"{out}/reference/airports"),
            iso,
            load_reference(spark, f"{out}/reference/port_codes"),
            names,
            former,
        ),
        f"{out}/ports",
    )


TEMPERATURE_SCHEMA = (
    "dt string, AverageTemperature double, AverageTemperatureUncertainty double, "
    "City string, Country string, Latitude string, Longitude string"
)


def pending_inputs(spark: SparkSession, inputs: Inputs, out: str) -> list[str]:
    """Labels of the arrivals files that the log of published files does not hold."""
    files = spark.createDataFrame([(m,) for m in inputs.arrivals], "batch string")
    log = f"{out}/landed/arrivals_log"
    if table_exists(spark, log):
        files = pending(files, read_table(spark, log), ["batch"], small=True)
    return sorted(r.batch for r in files.collect())


def build_facts(spark: SparkSession, inputs: Inputs, out: str) -> list[str]:
    """Publish all pending arrivals files together, then the dates of their months.

    All files of a format are landed by one scan and one write; then the months of all of them are merged into the fact at
    once, so a month is rewritten once however many files it came in, and pieces and repeats are safe. Cells that don't
    have the declared type become null in the fact and are listed in ``landed/arrivals_rejects``, with their file's label,
    by the same pass. The files are logged when all is published.
    """
    modes = code_labels(read_lines(spark, inputs.mode_lines), "transport_mode")
    visas = code_labels(read_lines(spark, inputs.visa_lines), "visa_category")
    done = pending_inputs(spark, inputs, out)
    if not done:
        return done
    landed = land_files(spark, {b: inputs.arrivals[b] for b in done}, f"{out}/landed/arrivals")
    raw = [conform(f.select(*fixed.ARRIVAL_COLUMNS, "batch"), fixed.ARRIVAL_TYPES, rejects="rejects") for f in landed]
    conformed = store(union_all(*raw), "arrivals-conformed")
    bad = rejected(conformed, "rejects", "batch")
    publish(bad, f"{out}/landed/arrivals_rejects", partition_by=["batch"], dynamic=True)
    fact = arrivals(conformed.drop("rejects", "batch"), modes, visas, distinct=False)
    publish_incremental(fact, f"{out}/arrivals", MONTH, key=fixed.ARRIVAL_KEY, stored=True)
    months = partitions_of(fact.select(*MONTH), MONTH, read_table(spark, f"{out}/arrivals", schema=fact.schema))
    publish_incremental(time_dimension(months), f"{out}/time", MONTH)
    publish(spark.createDataFrame([(b,) for b in done], "batch string"), f"{out}/landed/arrivals_log", mode="append")
    return done


def check_warehouse(spark: SparkSession, out: str, tables: Mapping[str, Sequence[str]] = fixed.TABLE_KEYS) -> list[str]:
    """Every table exists, has rows and has no null in its key; the first that fails raises."""
    return run_until_failure(spark, [(name, f"{out}/{name}", keys) for name, keys in tables.items()])


def build_warehouse(spark: SparkSession, inputs: Inputs, out: str) -> list[str]:
    """Run all steps; returns the arrivals files that were published."""
    build_reference(spark, inputs, out)
    build_dimensions(spark, inputs, out)
    done = build_facts(spark, inputs, out)
    check_warehouse(spark, out)
    return done


def fact_view(spark: SparkSession, out: str) -> DataFrame:
    """The fact with names from the dimensions, ready for reports."""
    fact = read_table(spark, f"{out}/arrivals").withColumn("residence_country", F.col("residence_country").cast("bigint"))
    countries = read_table(spark, f"{out}/countries").groupBy("i94_cntyl_code").agg(
        F.min("country_iso3166").alias("country_iso3166")
    )
    ports = read_table(spark, f"{out}/ports").groupBy("i94_prtl_code").agg(
        F.min("reference_port_loc").alias("reference_port_loc")
    )
    states = read_table(spark, f"{out}/state_boundaries")
    return star(
        fact,
        [
            (countries, {"residence_country": "i94_cntyl_code"}, {"country_iso3166": "country"}),
            (ports, {"port_of_entry": "i94_prtl_code"}, {"reference_port_loc": "port"}),
            (states, {"address_state": "state_code"}, {"state_name": "state"}),
        ],
    )
