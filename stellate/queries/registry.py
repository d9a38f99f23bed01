"""Registered queries: a Spark callable ``(spark, sf_dir) -> DataFrame`` and, where SQL can say it, its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function, under its own name by default, with its SQL twin."""

    def register(fn: Query) -> Query:
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = fn
        if sql is not None:
            SQL[key] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as an arrivals fact: arrival date, year and month next to the table's own columns."""
    return table(spark, sf_dir, "orders").withColumns(
        {
            "arrival_date": F.to_date("o_orderdate"),
            "year": F.year("o_orderdate"),
            "month": F.month("o_orderdate"),
        }
    )


# ---- SQL building blocks for the twins ---------------------------------------------------------------------------

YEAR_MONTH = "CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month"


def title_sql(x: str) -> str:
    runs = rf"regexp_extract_all({x}, '\p{{L}}+|\P{{L}}+')"
    return f"array_to_string(list_transform({runs}, lambda t: upper(t[1]) || lower(t[2:])), '')"


def norm_sql(x: str) -> str:
    return rf"trim(regexp_replace(lower({x}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"


def words_sql(x: str) -> str:
    return f"list_filter(list_distinct(string_split({x}, ' ')), lambda w: w <> '')"


def replace_sql(x: str, pairs: list[tuple[str, str]]) -> str:
    for old, new in pairs:
        x = "replace({}, '{}', '{}')".format(x, old.replace("'", "''"), new.replace("'", "''"))
    return x


def keyword_sql(x: str, pairs: list[tuple[str, str]]) -> str:
    quoted = [(k.replace("'", "''"), v.replace("'", "''")) for k, v in pairs]
    whens = " ".join(f"WHEN contains({x}, '{k}') THEN '{v}'" for k, v in quoted)
    return f"CASE {whens} ELSE {x} END"


def best_match_sql(labels: str, label: str, refs: str, ref: str, min_score: int | None = 70) -> str:
    """CTE body ``(label, match, score)``: nearest value of ``refs`` for each distinct label."""
    floor = 0 if min_score is None else min_score
    return f"""
        SELECT label, CASE WHEN score >= {floor} THEN value END AS match,
               CASE WHEN score >= {floor} THEN score END AS score
        FROM (
            SELECT label, value, CAST(greatest(edit, tok) AS INTEGER) AS score,
                   row_number() OVER (PARTITION BY label ORDER BY greatest(edit, tok) DESC, edit DESC, value) AS rn
            FROM (
                SELECT label, value,
                       CASE WHEN m = 0 THEN 0 ELSE (100 * (m - levenshtein(ln, rn))) // m END AS edit,
                       CASE WHEN s = 0 THEN 0 ELSE (90 * len(list_intersect(lw, rw))) // s END AS tok
                FROM (
                    SELECT *, greatest(length(ln), length(rn)) AS m, least(len(lw), len(rw)) AS s
                    FROM (SELECT label, ln, {words_sql('ln')} AS lw
                          FROM (SELECT DISTINCT {label} AS label, {norm_sql(label)} AS ln
                                FROM {labels} WHERE {label} IS NOT NULL)) l
                    CROSS JOIN (SELECT value, rn, {words_sql('rn')} AS rw
                                FROM (SELECT min({ref}) AS value, {norm_sql(ref)} AS rn
                                      FROM {refs} WHERE {norm_sql(ref)} <> '' GROUP BY {norm_sql(ref)})) r
                )
            )
        ) WHERE rn = 1
    """
