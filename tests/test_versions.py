"""Tables that change together, or not at all."""

import pytest

from stellate.operators import versions
from stellate.operators.versions import Piece, clean, publish_version, read_version

MONTH = ["year", "month"]


def fact(spark, ids, m=1, note="first"):
    return spark.createDataFrame([(i, 2016, m, note) for i in ids], "id int, year int, month int, note string")


def log(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "batch string")


def pieces(spark, ids, name, m=1, note="first"):
    return {"fact": Piece(fact(spark, ids, m, note), MONTH, key=["id"]), "log": Piece(log(spark, name), [], key=["batch"])}


def held(spark, root, version=None):
    rows = sorted(tuple(r) for r in read_version(spark, root, "fact", version).collect())
    return rows, sorted(r.batch for r in read_version(spark, root, "log", version).collect())


def test_versions_add_up(spark, tmp_path):
    root = str(tmp_path)
    assert publish_version(spark, root, pieces(spark, [1, 2], "a")) == 1
    assert publish_version(spark, root, pieces(spark, [2, 3], "b", note="late")) == 2
    assert publish_version(spark, root, pieces(spark, [9], "c", m=2)) == 3
    first = ([(1, 2016, 1, "first"), (2, 2016, 1, "first")], ["a"])
    second = ([(1, 2016, 1, "first"), (2, 2016, 1, "late"), (3, 2016, 1, "late")], ["a", "b"])
    assert held(spark, root, 1) == first and held(spark, root, 2) == second
    assert held(spark, root) == (second[0] + [(9, 2016, 2, "first")], ["a", "b", "c"])
    publish_version(spark, root, pieces(spark, [9], "c", m=2))
    assert held(spark, root) == held(spark, root, 3)


@pytest.mark.parametrize("step", ["stage", "commit"])
@pytest.mark.parametrize("number", [1, 2])
def test_a_run_that_dies_changes_nothing(spark, tmp_path, monkeypatch, step, number):
    """Killed before or after any write: the old version is whole, and the run can be repeated."""
    root = str(tmp_path)
    publish_version(spark, root, pieces(spark, [1, 2], "a"))
    before, original, calls = held(spark, root), getattr(versions, step), []

    def dies(*args):
        calls.append(step)
        if step == "commit" and number == 1:
            raise RuntimeError("killed")
        out = original(*args) if step == "stage" else None
        if step == "commit":  # the version is written, but never gets its name
            store, path = versions._store(spark, f"{root}/{versions.FOLDER}/.half.tmp")
            store.create(path, False).close()
            raise RuntimeError("killed")
        if len(calls) == number:
            raise RuntimeError("killed")
        return out

    monkeypatch.setattr(versions, step, dies)
    with pytest.raises(RuntimeError, match="killed"):
        publish_version(spark, root, pieces(spark, [2, 3], "b", note="late"))
    monkeypatch.setattr(versions, step, original)
    assert held(spark, root) == before and versions.versions(spark, root) == [1]
    assert publish_version(spark, root, pieces(spark, [2, 3], "b", note="late")) == 2
    assert held(spark, root)[1] == ["a", "b"]
    left = clean(spark, root, keep=1)
    assert held(spark, root)[0][-1] == (3, 2016, 1, "late") and any("fact/run=" in p for p in left)


def test_second_writer_is_refused(spark, tmp_path):
    root = str(tmp_path)
    publish_version(spark, root, pieces(spark, [1], "a"))
    tables = versions.tables_of(spark, root)
    with pytest.raises(RuntimeError):
        versions.commit(spark, root, tables, 0)


def test_untouched_partitions_are_not_written(spark, tmp_path):
    root = str(tmp_path)
    for m in (1, 2, 3):
        publish_version(spark, root, pieces(spark, [m], f"m{m}", m=m))
    now = versions.tables_of(spark, root)["fact"]["partitions"]
    publish_version(spark, root, pieces(spark, [7], "more", m=2))
    then = versions.tables_of(spark, root)["fact"]["partitions"]
    assert {p for p in then if then[p] != now[p]} == {"year=2016/month=2"}
    assert read_version(spark, root, "fact").count() == 4


def test_nothing_published(spark, tmp_path):
    with pytest.raises(ValueError):
        read_version(spark, str(tmp_path), "fact")
    publish_version(spark, str(tmp_path), pieces(spark, [], "a"))
    assert held(spark, str(tmp_path)) == ([], ["a"])
    with pytest.raises(ValueError):
        read_version(spark, str(tmp_path), "fact", 5)
