"""Incremental key checks against the full report."""

import pytest

from stellate.operators import key_state
from stellate.operators.incremental import publish_incremental
from stellate.operators.key_state import incremental_key_report
from stellate.operators.quality import key_report
from stellate.sources.readers import read_table


def rows(spark, ids, m):
    return spark.createDataFrame([(i, f"k{i}" if i is not None and i % 2 else None if i is None else "even", m) for i in ids], "a int, b string, m int")


def both(spark, path, keys, state, partition_by=("m",)):
    report, parts = incremental_key_report(spark, path, keys, state, partition_by, "t")
    want = key_report(read_table(spark, path), keys, "t")
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, want.collect()))
    return {r.check_name: r.failed_rows for r in report.collect()}, parts


@pytest.mark.parametrize("keys", [["a"], ["a", "b"]])
def test_only_changed_partitions_are_read(spark, tmp_path, keys):
    path, state = f"{tmp_path}/t", f"{tmp_path}/state"
    publish_incremental(rows(spark, range(20), 1), path, ["m"])
    publish_incremental(rows(spark, range(20, 30), 2), path, ["m"])
    found, parts = both(spark, path, keys, state)
    assert found == {"not_empty": 0, "not_null": 0, "unique": 0} and len(parts) == 2
    assert both(spark, path, keys, state)[1] == []
    # a key that another partition has, one twice in its own, and one without value
    publish_incremental(rows(spark, [5, 40, 40, None], 3), path, ["m"])
    found, parts = both(spark, path, keys, state)
    assert found == {"not_empty": 0, "not_null": 1, "unique": 2} and parts == ['{"m":"3"}']
    publish_incremental(rows(spark, [50], 3), path, ["m"])
    assert both(spark, path, keys, state) == ({"not_empty": 0, "not_null": 0, "unique": 0}, ['{"m":"3"}'])


def test_partitions_that_go(spark, tmp_path):
    path, state = f"{tmp_path}/t", f"{tmp_path}/state"
    rows(spark, [1, 1, 2], 1).unionByName(rows(spark, [2], 2)).write.partitionBy("m").parquet(path)
    assert both(spark, path, ["a"], state)[0]["unique"] == 2
    rows(spark, [2], 2).write.mode("overwrite").partitionBy("m").parquet(path)
    assert both(spark, path, ["a"], state)[0]["unique"] == 0


def test_equal_hashes_are_no_proof(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(key_state, "_hash", lambda keys: F.lit(1).cast("long"))
    path = f"{tmp_path}/t"
    rows(spark, [1, 2, 3, 3], 1).write.parquet(path)
    assert both(spark, path, ["a"], f"{tmp_path}/state", ())[0]["unique"] == 1


def test_a_check_that_dies_is_repeated(spark, tmp_path, monkeypatch):
    path, state = f"{tmp_path}/t", f"{tmp_path}/state"
    publish_incremental(rows(spark, [1, 1], 1), path, ["m"])
    original = key_state.publish

    def dies(df, where, **options):
        if where.endswith("files"):
            raise RuntimeError("killed")
        return original(df, where, **options)

    monkeypatch.setattr(key_state, "publish", dies)
    with pytest.raises(RuntimeError):
        incremental_key_report(spark, path, ["a"], state, ["m"])
    monkeypatch.setattr(key_state, "publish", original)
    assert both(spark, path, ["a"], state) == ({"not_empty": 0, "not_null": 0, "unique": 1}, ['{"m":"1"}'])


def test_empty_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows(spark, [], 1).write.parquet(path)
    assert both(spark, path, ["a"], f"{tmp_path}/state", ())[0]["not_empty"] == 1
