"""Lookup joins: every path gives the plain join's result."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from stellate.operators import joins


def bag(df):
    cols = sorted(df.columns)
    return Counter(tuple(r) for r in df.select(*cols).collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows holds one key, another part has no key."""
    return spark.range(6_000).select(
        F.expr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 10 = 1 THEN NULL ELSE id % 900 END").alias("k"), "id"
    )


@pytest.fixture(scope="module")
def ref(spark):
    return spark.range(0, 800, 1).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_all_paths_agree(spark, skewed, ref, how):
    plain = bag(skewed.join(ref, "k", how))
    assert bag(joins.lookup_join(skewed, ref, ["k"], how)) == plain
    assert bag(joins.lookup_join(skewed, ref, ["k"], how, small=False)) == plain
    assert bag(joins.lookup_join(skewed, ref, ["k"], how, small=False, hot=300)) == plain


@pytest.mark.parametrize("how", ["left", "left_anti"])
def test_repeated_reference_keys(skewed, ref, how):
    twice = ref.unionByName(ref)
    plain = bag(skewed.join(twice, "k", how))
    assert bag(joins.lookup_join(skewed, twice, ["k"], how, small=False, hot=300)) == plain


@pytest.mark.parametrize("type_", ["int", "smallint", "double", "string"])
def test_keys_of_different_types(skewed, ref, type_):
    other = ref.withColumn("k", F.col("k").cast(type_))
    plain = bag(skewed.join(ref, "k", "left"))
    assert bag(joins.lookup_join(skewed, other, ["k"], small=False, hot=300)) == plain


def test_hot_keys_are_found(skewed):
    hash_ = F.xxhash64(F.col("k").cast("double"))
    want = {r.h for r in skewed.where("k = 7 OR k IS NULL").select(hash_.alias("h")).distinct().collect()}
    (hot,) = joins.hot_keys(skewed, [["k"]], hot_rows=300)
    assert set(hot) == want
    assert joins.hot_keys(skewed, [["k"], ["id"]]) == [[], []]
    assert joins.hot_keys(skewed.limit(0), [["k"]]) == [[]]


def test_hot_rows_are_dealt_to_many_tasks(spark, skewed, ref):
    joined = joins.lookup_join(skewed, ref, ["k"], small=False, hot=300, salts=8)
    per_task = [r["count"] for r in joined.where("k = 7").groupBy(F.spark_partition_id()).count().collect()]
    assert len(per_task) > 2 or joined.rdd.getNumPartitions() <= 2


@pytest.mark.parametrize("hot_rows", [None, 300])
def test_the_fact_is_read_a_constant_number_of_times(spark, tmp_path, skewed, hot_rows):
    path = str(tmp_path / "fact")
    skewed.withColumns({f"k{i}": F.col("k") for i in range(4)}).write.parquet(path)
    fact = spark.read.parquet(path)
    dims = [(spark.range(800).select("id", F.concat(F.lit(f"v{i}-"), "id").alias("v")), {f"k{i}": "id"}, {"v": f"v{i}"}) for i in range(4)]
    for n in range(1, 5):
        out = joins.star(fact, dims[:n], small=False, hot_rows=hot_rows)
        text = out._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("Relation [") == 1 and text.count("Join LeftOuter") == n
    plain = fact
    for i, (dim, _, _) in enumerate(dims):
        plain = plain.join(dim.select(F.col("id").alias(f"k{i}"), F.col("v").alias(f"v{i}")), f"k{i}", "left")
    assert bag(out) == bag(plain)


def test_size_limits(spark, ref):
    assert joins.measure(ref)[0] == 800
    assert joins.is_small(ref)
    assert not joins.is_small(ref, max_rows=799)
    assert not joins.is_small(ref, max_bytes=100)


def test_fanout(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, "b"), (1, "a")], "k int, v string")
    run = lambda **o: sorted(joins.attach_reference(left, right, {"k": "k"}, {"v": "v"}, **o).collect())
    assert [tuple(r) for r in run()] == [(1, "a"), (1, "b"), (2, None)]
    assert [tuple(r) for r in run(fanout="first", order_by=["v"])] == [(1, "a"), (2, None)]
    with pytest.raises(ValueError, match="repeat"):
        run(fanout="error")
    with pytest.raises(ValueError, match="fanout"):
        run(fanout="some")


def test_lookup_chain_precedence(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string")
    first = spark.createDataFrame([("a", "1a"), ("a", "0a"), ("b", None)], "k string, v string")
    second = spark.createDataFrame([("a", "2a"), ("b", "2b")], "k string, v string")
    out = joins.lookup_chain(df, "k", [(first, "k", "v"), (second, "k", "v")], "place")
    assert {r.k: r.place for r in out.collect()} == {"a": "0a", "b": "2b", "c": None, None: None}


def test_map_codes(spark):
    df = spark.createDataFrame([(1.0,), (9.0,), (1.5,), (None,)], "mode double")
    label = lambda frame, mapping, **o: sorted((r.m for r in joins.map_codes(frame, frame.columns[0], mapping, "m", **o).collect()), key=lambda x: (x is None, x))
    assert label(df, {1: "Air", 2: "Sea"}) == ["Air", None, None, None]
    assert label(df, {}) == [None] * 4
    assert label(df, {i: str(i) for i in range(200)}) == ["1", "9", None, None]
    big = spark.createDataFrame([(5_000_000_000,), (2,)], "code bigint")
    assert label(big, {5_000_000_000: "x"}) == ["x", None]
    text = spark.createDataFrame([("1",), ("01",), ("b",), (None,)], "code string")
    assert label(text, {"b": "B", "1": "one"}) == ["B", "one", None, None]
    assert label(text, {1: "one"}) == ["one", "one", None, None]
    twice = spark.createDataFrame([(1, "b"), (1, "a"), (None, "c"), (1, None)], "code int, label string")
    assert label(df, twice) == ["a", None, None, None]
    assert len(label(df, twice, fanout="allow")) == 6
    with pytest.raises(ValueError, match="repeat"):
        label(df, twice, fanout="error")
