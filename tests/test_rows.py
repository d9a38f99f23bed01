"""Filters, duplicate removal, quality checks: fixtures and properties."""

import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stellate.functions import edit_score, label_is, normalise
from stellate.operators import aggregates as agg
from stellate.operators import filters, quality
from stellate.operators.shape import cast_columns, sanitise_name

FEW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@given(st.text())
def test_sanitise_is_idempotent(name):
    assert sanitise_name(sanitise_name(name)) == sanitise_name(name)


@FEW
@given(st.lists(st.one_of(st.none(), st.sampled_from(["red one", "small", "blue", "a red", ""])), min_size=1, max_size=20))
def test_split_partitions_the_input(spark, labels):
    df = spark.createDataFrame([(l,) for l in labels], "label string")
    match, rest = filters.split_by(df, label_is("label", ["red", "small"]))
    got = Counter(r.label for r in match.collect()) + Counter(r.label for r in rest.collect())
    assert got == Counter(labels)
    assert all(r.label is not None for r in match.collect())


@FEW
@given(st.randoms(use_true_random=False))
def test_dedupe_by_key_ignores_input_order(spark, rng):
    rows = [(k, v, w) for k in range(4) for v in range(3) for w in ("x", "y", None)]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    run = lambda data: set(
        map(tuple, agg.dedupe_by_key(spark.createDataFrame(data, "k int, v int, w string"), ["k"], [F.desc("v"), "w"]).collect())
    )
    assert run(shuffled) == run(rows) == {(k, 2, None) for k in range(4)}


@FEW
@given(st.text(alphabet="aB é-'9", min_size=0, max_size=12))
def test_normalise_is_idempotent(spark, text):
    df = spark.createDataFrame([(text,)], "c string").select(normalise("c").alias("n"))
    assert df.select(normalise("n") == F.col("n")).first()[0]


def test_dedupe_by_key_needs_an_order(spark):
    with pytest.raises(ValueError):
        agg.dedupe_by_key(spark.range(3), ["id"], [])


def test_null_filters(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "n int, s string")
    assert [r.n for r in filters.drop_nulls(df).collect()] == [1]
    assert [r.n for r in filters.drop_nulls(df, ["n"]).collect()] == [1, 3]
    assert [r.n for r in filters.drop_sentinel(df, "s", "a").collect()] == [None]


def test_casts(spark):
    df = spark.createDataFrame([("1",), ("x",)], "c string")
    assert [r.c for r in cast_columns(df, ["c"], "int").collect()] == [1, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cast_columns(df, ["c"], "int", on_error="fail").collect()


def test_union_goes_by_name(spark):
    a, b = spark.sql("SELECT 1 AS x, 2 AS y"), spark.sql("SELECT 3 AS y, 4 AS x")
    assert [tuple(r) for r in agg.union_all(a, b).collect()] == [(1, 2), (4, 3)]


def test_composite_key_with_nulls(spark):
    df = spark.createDataFrame([("a", "x"), (None, "y"), ("b", None)], "k1 string, k2 string")
    assert quality.check_not_null(df, ["k1", "k2"]).first().failed_rows == 2


def test_reports_agree_with_single_checks(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b"])) for _ in range(60)]
    df = spark.createDataFrame(rows, "k1 int, k2 string")
    keys = ["k1", "k2"]
    single = agg.union_all(
        quality.check_not_empty(df, "t"), quality.check_not_null(df, keys, "t"), quality.check_unique(df, keys, "t")
    )
    want = {r.check_name: r.failed_rows for r in single.collect()}
    assert {r.check_name: r.failed_rows for r in quality.key_report(df, keys, "t").collect()} == want
    del want["unique"]
    assert {r.check_name: r.failed_rows for r in quality.null_report(df, keys, "t").collect()} == want


def test_empty_table_fails(spark):
    empty = spark.createDataFrame([], "k int")
    assert quality.check_not_empty(empty).first().failed_rows == 1
    report = quality.run_checks({"t": (empty, ["k"])})
    assert quality.failures(report) == ["t: check not_empty failed for 1 rows"]
    with pytest.raises(ValueError, match="not_empty"):
        quality.raise_on_failure(report)


def test_missing_table_fails(spark, tmp_path):
    assert not quality.check_exists(spark, str(tmp_path / "none")).first().passed


def test_null_profile(spark):
    df = spark.createDataFrame([(None, "a"), (None, None)], "`a b` int, c string")
    assert {r.column_name: r.null_count for r in agg.null_profile(df).collect()} == {"a b": 2, "c": 1}
    assert tuple(agg.profile(df).first()) == (2, 2)


@FEW
@given(st.text(alphabet="abc XYZ-.'9é", min_size=1, max_size=15).filter(lambda s: any(ch.isalnum() for ch in s)))
def test_a_label_scores_100_with_itself(spark, text):
    df = spark.createDataFrame([(text,)], "c string").select(normalise("c").alias("n"))
    assert df.select(edit_score(F.col("n"), F.col("n"))).first()[0] == 100
