"""Filters, duplicate removal, profiles and unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import label_is
from ..operators import aggregates as agg
from ..operators import filters
from .registry import query, table

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def _holed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in which views have lost their type and values below 2 are missing."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.nullif("event_type", F.lit("view")).alias("event_type"),
        F.when(F.col("value") >= 2, F.col("value")).alias("value"),
    )


_HOLED = """(SELECT event_id, nullif(event_type, 'view') AS event_type,
             CASE WHEN value >= 2 THEN value END AS value FROM events)"""


@query(f"SELECT * FROM {_HOLED} WHERE event_type <> 'error'")
def drop_sentinel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.drop_sentinel(_holed_events(spark, sf_dir), "event_type", "error")


@query(f"SELECT * FROM {_HOLED} WHERE event_type IS NOT NULL")
def keep_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.keep_not_null(_holed_events(spark, sf_dir), "event_type")


@query(f"SELECT * FROM {_HOLED} WHERE event_id IS NOT NULL AND event_type IS NOT NULL AND value IS NOT NULL")
def drop_null_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.drop_nulls(_holed_events(spark, sf_dir))


@query(f"SELECT * FROM {_HOLED} WHERE value IS NOT NULL")
def drop_null_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.drop_nulls(_holed_events(spark, sf_dir), ["value"])


@query(
    """SELECT p_partkey, label, CASE WHEN label LIKE 'red%' OR label LIKE 'small%' THEN 'match' ELSE 'rest' END AS half
       FROM (SELECT p_partkey, CASE WHEN p_type <> 'PROMO' THEN p_name END AS label FROM part)"""
)
def split_union_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "part").select(
        "p_partkey", F.when(F.col("p_type") != "PROMO", F.col("p_name")).alias("label")
    )
    match, rest = filters.split_by(labels, label_is("label", ["red", "small"]))
    # The halves name their columns in different orders: the union goes by name.
    return agg.union_all(
        match.withColumn("half", F.lit("match")), rest.select(F.lit("rest").alias("half"), "label", "p_partkey")
    )


@query("SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem)")
def dedupe_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return agg.dedupe(agg.union_all(lines, lines).select("l_orderkey", "l_linenumber", "l_returnflag"))


_VALUES = "l_shipdate DESC, l_extendedprice, l_partkey, l_suppkey, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus"


@query(
    f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY {_VALUES}) AS rn FROM lineitem) WHERE rn = 1"""
)
def dedupe_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.desc("l_shipdate"), *[F.asc(c) for c in _VALUES.split(", ")[1:]]]
    return agg.dedupe_by_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], order)


@query(
    """SELECT * FROM (SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice,
         CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber,
              l_partkey, l_quantity) AS INTEGER) AS place FROM lineitem) WHERE place <= 3"""
)
def top_three_per_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = agg.top_per_group(
        table(spark, sf_dir, "lineitem"),
        ["l_suppkey"],
        [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"],
        n=3,
        rank="place",
    )
    return ranked.select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice", "place")


@query("SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


_WIDTHS = {
    "region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11, "events": 6,
    "documents": 5, "embeddings": 3, "pages": 3, "benchmark": 2, "labels": 3, "conversations": 4,
}


@query(
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, CAST({_WIDTHS[t]} AS INTEGER) AS n_columns FROM {t}" for t in TABLES
    )
)
def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.union_all(
        *[agg.profile(table(spark, sf_dir, t)).select(F.lit(t).alias("table_name"), "n_rows", "n_columns") for t in TABLES]
    )


@query(
    f"""SELECT 'event_id' AS column_name, count(*) FILTER (event_id IS NULL) AS null_count FROM {_HOLED}
        UNION ALL SELECT 'event_type', count(*) FILTER (event_type IS NULL) FROM {_HOLED}
        UNION ALL SELECT 'value', count(*) FILTER (value IS NULL) FROM {_HOLED}"""
)
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.null_profile(_holed_events(spark, sf_dir))
