"""Quality reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality
from ..operators.aggregates import union_all
from ..operators.incremental import publish_incremental
from ..operators.key_state import incremental_key_report
from ..sources.sinks import publish
from ..sources.workspace import new_dir
from .registry import dated_orders, query, table

KEYS = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey"],
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_linenumber"],
    "events": ["event_id"],
    "documents": ["doc_id"],
    "embeddings": ["vec_id"],
    "pages": ["page_id"],
    "benchmark": ["item_id"],
    "labels": ["doc_id"],
    "conversations": ["conv_id", "turn"],
}


def _table_sql(name: str, keys: list[str]) -> str:
    any_null = " OR ".join(f"{k} IS NULL" for k in keys)
    all_there = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return f"""SELECT '{name}' AS table_name, 'not_empty' AS check_name,
                 CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) AS failed_rows FROM {name}
        UNION ALL SELECT '{name}', 'not_null', CAST(count(*) FILTER ({any_null}) AS BIGINT) FROM {name}
        UNION ALL SELECT '{name}', 'unique', CAST(count(*) AS BIGINT) FROM
            (SELECT 1 FROM {name} WHERE {all_there} GROUP BY {', '.join(keys)} HAVING count(*) > 1)"""


@query(
    "SELECT *, failed_rows = 0 AS passed FROM ("
    + " UNION ALL ".join(_table_sql(t, k) for t, k in KEYS.items())
    + ")"
)
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.run_checks({t: (table(spark, sf_dir, t), keys) for t, keys in KEYS.items()})


@query(
    """SELECT *, failed_rows = 0 AS passed FROM (
       SELECT 'exists' AS check_name, 'lineitem' AS table_name, CAST(0 AS BIGINT) AS failed_rows
       UNION ALL SELECT 'exists', 'no_such_table', 1
       UNION ALL SELECT 'not_empty', 'lineitem', CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM lineitem
       UNION ALL SELECT 'not_null', 'lineitem', count(*) FILTER (l_returnflag = 'R' OR l_linestatus = 'F') FROM lineitem
       UNION ALL SELECT 'unique', 'lineitem', count(*) FROM (
         SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))"""
)
def single_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each check by itself. The composite key (flag, status) has holes in either column."""
    lines = table(spark, sf_dir, "lineitem")
    holed = lines.select(
        F.nullif("l_returnflag", F.lit("R")).alias("flag"), F.nullif("l_linestatus", F.lit("F")).alias("status")
    )
    return union_all(
        quality.check_exists(spark, f"{sf_dir}/lineitem.parquet", "lineitem"),
        quality.check_exists(spark, f"{sf_dir}/no_such_table.parquet", "no_such_table"),
        quality.check_not_empty(lines, "lineitem"),
        quality.check_not_null(holed, ["flag", "status"], "lineitem"),
        quality.check_unique(lines, ["l_orderkey", "l_linenumber"], "lineitem"),
    )


@query(
    """SELECT 'customer: check not_null failed for ' || count(*) || ' rows' AS message, CAST(2 AS BIGINT) AS published
       FROM customer WHERE c_mktsegment = 'BUILDING'"""
)
def suite_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published tables are checked in order; the second fails, so the third, which does not exist, is not reached."""
    out = new_dir(spark, "suite")
    publish(table(spark, sf_dir, "nation"), f"{out}/nation")
    holed = table(spark, sf_dir, "customer").withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    publish(holed, f"{out}/customer")
    suite = [("nation", ["n_nationkey"]), ("customer", ["c_custkey", "c_mktsegment"]), ("no_such_table", ["id"])]
    try:
        quality.run_until_failure(spark, [(name, f"{out}/{name}", keys) for name, keys in suite])
        message = "nothing failed"
    except ValueError as e:
        message = str(e)
    return spark.createDataFrame([(message, 2)], "message string, published long")


_STATED = "(SELECT *, CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 50 = 1 THEN 7 ELSE o_orderkey END AS k FROM orders)"


@query(
    f"""SELECT 'orders' AS table_name, 'not_empty' AS check_name, CAST(0 AS BIGINT) AS failed_rows, TRUE AS passed
        UNION ALL SELECT 'orders', 'not_null', count(*) FILTER (k IS NULL), count(*) FILTER (k IS NULL) = 0 FROM {_STATED}
        UNION ALL SELECT 'orders', 'unique', count(*), count(*) = 0
          FROM (SELECT k FROM {_STATED} WHERE k IS NOT NULL GROUP BY k HAVING count(*) > 1)"""
)
def incremental_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of a table that grows month by month: the last check reads the months since the one before only."""
    path, state = new_dir(spark, "orders"), new_dir(spark, "orders-keys")
    k = F.expr("IF(o_orderkey % 9 = 0, NULL, IF(o_orderkey % 50 = 1, 7, o_orderkey))")
    orders = dated_orders(spark, sf_dir).select(k.alias("k"), "year", "month")
    for piece in (orders.where("month <= 10"), orders.where("month > 10")):
        publish_incremental(piece, path, ["year", "month"])
        report, _ = incremental_key_report(spark, path, ["k"], state, ["year", "month"], "orders")
    return report
