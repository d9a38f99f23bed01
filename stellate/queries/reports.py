"""Reports over the fact: by month, category, country, day of week; favourites and peaks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregates import first_rows
from ..operators.joins import map_codes, star
from ..plans import arrivals
from .registry import YEAR_MONTH, dated_orders, query, table

STATUS = {"O": "Open", "F": "Filled", "P": "Pending"}

SEASON_SQL = """CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'winter' WHEN month(o_orderdate) IN (3, 4, 5) THEN 'spring'
    WHEN month(o_orderdate) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END"""


@query(
    f"""SELECT {YEAR_MONTH}, CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Filled' WHEN 'P' THEN 'Pending' END
        AS category, count(*) AS visitors FROM orders GROUP BY ALL"""
)
def monthly_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = map_codes(dated_orders(spark, sf_dir), "o_orderstatus", STATUS, "category")
    return arrivals.monthly_by_category(fact, "category")


@query(
    f"""SELECT {YEAR_MONTH}, n_name, CAST(count(*) AS BIGINT) AS visitors FROM orders
        LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL"""
)
def monthly_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = star(
        dated_orders(spark, sf_dir).select("o_custkey", "year", "month"),
        [(table(spark, sf_dir, "customer"), {"o_custkey": "c_custkey"}, {"c_nationkey": "c_nationkey"})],
    )
    return arrivals.monthly_by_country(fact, table(spark, sf_dir, "nation"), "c_nationkey", "n_nationkey", "n_name")


@query(
    """SELECT CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS day_of_week, count(*) AS visitors
       FROM orders GROUP BY ALL"""
)
def by_day_of_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrivals.by_day_of_week(dated_orders(spark, sf_dir))


@query(
    """SELECT n_name, c_mktsegment, visitors FROM (
         SELECT n_name, c_mktsegment, count(*) AS visitors,
                row_number() OVER (PARTITION BY n_name ORDER BY count(*) DESC, c_mktsegment) AS rn
         FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
         GROUP BY n_name, c_mktsegment) WHERE rn = 1"""
)
def top_segment_per_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = star(
        table(spark, sf_dir, "orders").select("o_custkey"),
        [
            (
                table(spark, sf_dir, "customer"),
                {"o_custkey": "c_custkey"},
                {"c_nationkey": "c_nationkey", "c_mktsegment": "c_mktsegment"},
            ),
            (table(spark, sf_dir, "nation"), {"c_nationkey": "n_nationkey"}, {"n_name": "n_name"}),
        ],
    )
    return arrivals.favourite_per_group(fact, "n_name", "c_mktsegment")


@query(
    """SELECT CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS visitors FROM orders
       GROUP BY 1 ORDER BY visitors DESC, month LIMIT 1"""
)
def peak_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrivals.peak_month(dated_orders(spark, sf_dir))


@query(
    f"""SELECT {SEASON_SQL} AS season, count(*) AS visitors FROM orders
        GROUP BY 1 ORDER BY visitors DESC, season LIMIT 1"""
)
def peak_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrivals.peak_season(dated_orders(spark, sf_dir))


@query(
    """SELECT r_name, CAST(year(o_orderdate) AS INTEGER) AS year, l_returnflag, count(*) AS n_lines,
              CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS quantity,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS revenue
       FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
       LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY ALL"""
)
def star_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = star(
        table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_quantity", "l_extendedprice"),
        [
            (
                dated_orders(spark, sf_dir),
                {"l_orderkey": "o_orderkey"},
                {"o_custkey": "o_custkey", "year": "year"},
            ),
            (table(spark, sf_dir, "customer"), {"o_custkey": "c_custkey"}, {"c_nationkey": "c_nationkey"}),
            (table(spark, sf_dir, "nation"), {"c_nationkey": "n_nationkey"}, {"n_regionkey": "n_regionkey"}),
            (table(spark, sf_dir, "region"), {"n_regionkey": "r_regionkey"}, {"r_name": "r_name"}),
        ],
    )
    exact = lambda c: F.sum(F.col(c).cast("decimal(18,2)")).cast("double")
    return joined.groupBy("r_name", "year", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n_lines"),
        exact("l_quantity").alias("quantity"),
        exact("l_extendedprice").alias("revenue"),
    )


@query(
    """SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10"""
)
def first_rows_for_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return first_rows(rows, 10, [F.desc("o_totalprice"), F.asc("o_orderkey")])
