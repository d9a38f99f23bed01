"""Physical plans: what must and what must not be in them."""

import pytest
from pyspark.sql import functions as F

from stellate.operators import aggregates as agg
from stellate.operators import joins
from stellate.operators.fuzzy import match_labels
from stellate.queries import checks, columns, lookups, published, registry, reports, rows, tables  # noqa: F401
from stellate.sources import readers, sinks

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_python_and_no_nested_loop(spark, name):
    text = plan(registry.QUERIES[name](spark, SF))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_groups_are_cut_before_the_shuffle(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet")
    text = plan(agg.dedupe_by_key(df, ["l_orderkey"], ["l_shipdate"]))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_reference_is_broadcast_and_columns_are_pruned(spark):
    orders, customer = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("orders", "customer"))
    text = plan(joins.attach_reference(orders.select("o_custkey"), customer, {"o_custkey": "c_custkey"}, {"c_name": "name"}))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "c_acctbal" not in text and "o_totalprice" not in text


def test_filters_reach_the_scan(spark):
    text = plan(spark.read.parquet(f"{SF}/orders.parquet").transform(lambda d: d.where(F.col("o_orderstatus") != "P")))
    assert "PushedFilters: [IsNotNull(o_orderstatus), Not(EqualTo(o_orderstatus,P))]" in text


def test_partitions_are_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.publish(spark.range(100).withColumn("year", F.col("id") % 4), path, partition_by=["year"])
    text = plan(readers.read_table(spark, path).where("year = 2"))
    assert "PartitionFilters: [isnotnull(year" in text


def test_copies_collapse_before_the_shuffle(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey", "l_returnflag")
    text = plan(agg.dedupe(df))
    assert text.count("HashAggregate") == 2


def test_top_rows_need_no_sort(spark):
    df = spark.read.parquet(f"{SF}/orders.parquet")
    assert "TakeOrderedAndProject" in plan(agg.first_rows(df, 5, ["o_orderkey"]))


@pytest.mark.parametrize("max_packed", [2_000, 0], ids=["short", "long"])
def test_label_matching_makes_no_cross_join(spark, max_packed):
    names = spark.read.parquet(f"{SF}/part.parquet").select("p_name").distinct()
    text = plan(match_labels(names, "p_name", names, "p_name", 70, max_packed=max_packed))
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text
