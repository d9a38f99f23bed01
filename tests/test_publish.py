"""Scans, sinks, repeated publishing, streaming."""

import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from stellate.operators import incremental
from stellate.operators.incremental import partitions_of, pending, publish_incremental
from stellate.operators.shape import conform, rejected
from stellate.sources import readers, sinks, workspace
from stellate.streaming import stream_files

MONTH = ["year", "month"]


def month(spark, m, ids, note="first"):
    return spark.createDataFrame([(i, 2016, m, note) for i in ids], "cicid int, year int, month int, note string")


def counts(spark, path):
    return {r.month: r["count"] for r in readers.read_table(spark, path).groupBy("month").count().collect()}


def test_publish_twice(spark, tmp_path):
    path = str(tmp_path / "fact")
    for _ in range(2):
        publish_incremental(month(spark, 1, [1, 2, 3]), path, MONTH)
        publish_incremental(month(spark, 2, [1, 2]), path, MONTH)
    assert counts(spark, path) == {1: 3, 2: 2}


def test_pieces_are_merged(spark, tmp_path):
    path = str(tmp_path / "fact")
    key = ["cicid", "year", "month"]
    publish_incremental(month(spark, 1, [1, 2, 3]), path, MONTH, key=key)
    publish_incremental(month(spark, 2, [1]), path, MONTH, key=key)
    publish_incremental(month(spark, 1, [3, 4], "second"), path, MONTH, key=key)
    rows = {(r.cicid, r.month): r.note for r in readers.read_table(spark, path).collect()}
    assert rows == {(1, 1): "first", (2, 1): "first", (3, 1): "second", (4, 1): "second", (1, 2): "first"}


def test_rows_without_a_month_are_merged_too(spark, tmp_path):
    path = str(tmp_path / "fact")
    batch = month(spark, None, [1, 2])
    for _ in range(2):
        publish_incremental(batch, path, MONTH, key=["cicid", "year", "month"])
    assert counts(spark, path) == {None: 2}


def test_pending(spark):
    files = spark.createDataFrame([("jan16",), ("feb16",), (None,)], "batch string")
    done = spark.createDataFrame([("jan16",), ("jan16",)], "batch string")
    assert {r.batch for r in pending(files, done, ["batch"]).collect()} == {"feb16", None}


def test_file_control(spark, tmp_path):
    df = spark.range(1000).withColumn("c", F.col("id") % 3)
    files = lambda p: glob.glob(f"{p}/**/*.parquet", recursive=True)
    sinks.publish(df, str(tmp_path / "n"), n_files=4)
    assert len(files(tmp_path / "n")) == 4
    sinks.publish(df, str(tmp_path / "c"), partition_by=["c"], cluster_by=["c"])
    assert len(files(tmp_path / "c")) == 3
    sinks.publish(df, str(tmp_path / "m"), n_files=1, max_records_per_file=300)
    assert len(files(tmp_path / "m")) == 4
    sinks.publish(df, str(tmp_path / "s"), n_files=1, sort_within=["c", "id"])
    assert [r.id for r in readers.read_table(spark, str(tmp_path / "s")).collect()][:3] == [0, 3, 6]
    with pytest.raises(ValueError):
        sinks.publish(df, str(tmp_path / "x"), n_files=1, cluster_by=["c"])


def test_full_files_by_many_tasks(spark, tmp_path):
    """Files that are cut by rows need no task that reads the whole table."""
    df = spark.range(0, 5_003, numPartitions=7).where("id % 7 <> 3").withColumn("file_number", F.lit("x"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one task's
    try:
        sinks.publish(df, str(tmp_path / "m"), n_files=1, max_records_per_file=100)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    stored = spark.read.parquet(str(tmp_path / "m"))
    sizes = sorted(r["count"] for r in stored.groupBy(F.input_file_name()).count().collect())
    assert len(sizes) == -(-df.count() // 100) and set(sizes[1:]) == {100}
    tasks = {name.rsplit("/", 1)[1].split("-")[1] for name in stored.inputFiles()}
    assert len(tasks) > 1
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, df.collect()))
    sinks.publish(df.limit(0), str(tmp_path / "e"), n_files=1, max_records_per_file=100)
    assert spark.read.parquet(str(tmp_path / "e")).count() == 0


def test_some_files_without_a_shuffle(spark, tmp_path):
    df = spark.range(0, 1_001, numPartitions=7).withColumn("file_number", F.col("id") % 3)
    dealt = sinks._gathered(df, 4, str(tmp_path / "work"))
    assert "Exchange" not in dealt._jdf.queryExecution().executedPlan().toString()
    assert dealt.rdd.getNumPartitions() == 4
    sinks.publish(df, str(tmp_path / "n"), n_files=4)
    stored = spark.read.parquet(str(tmp_path / "n"))
    sizes = sorted(r["count"] for r in stored.groupBy(F.input_file_name()).count().collect())
    assert len(sizes) == 4 and sizes[-1] - sizes[0] <= 7
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, df.collect()))
    sinks.publish(df.limit(0), str(tmp_path / "e"), n_files=4)
    assert spark.read.parquet(str(tmp_path / "e")).count() == 0


def test_tables_published_together(spark, tmp_path):
    """Each is made only when the others are under way; a failure is raised."""
    import threading

    meet = threading.Barrier(3)

    def make(n):
        meet.wait(60)
        return spark.range(n)

    sinks.publish_together({str(tmp_path / str(n)): lambda n=n: make(n) for n in (3, 4, 5)})
    assert [spark.read.parquet(str(tmp_path / str(n))).count() for n in (3, 4, 5)] == [3, 4, 5]
    with pytest.raises(ZeroDivisionError):
        sinks.publish_together({str(tmp_path / "a"): lambda: spark.range(1), str(tmp_path / "b"): lambda: 1 / 0})


def test_append(spark, tmp_path):
    for _ in range(2):
        sinks.publish(spark.range(3), str(tmp_path / "t"), mode="append")
    assert readers.read_table(spark, str(tmp_path / "t")).count() == 6


def test_landing_returns_only_the_batch(spark, tmp_path):
    raw = spark.range(3).withColumnRenamed("id", "Some Id")
    target = str(tmp_path / "landed")
    assert sinks.land(raw, target, batch="a").columns == ["some_id"]
    assert sinks.land(raw.limit(1), target, batch="b").count() == 1
    assert sinks.land(raw, target, batch="a").count() == 3
    assert readers.read_table(spark, target).count() == 4


def test_base_path_keeps_partition_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.publish(month(spark, 3, [1]), path, partition_by=MONTH)
    assert "year" not in readers.read_table(spark, f"{path}/*/*").columns
    assert set(MONTH) <= set(readers.read_table(spark, f"{path}/*/*", base_path=path).columns)


def test_formats(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Country,"Alpha-2 code"\nAfghanistan," ""AF"""\n')
    (tmp_path / "b.txt").write_text("1 = 'Air'\n\n2 = 'Sea'")
    codes = readers.read_any(spark, str(tmp_path / "a.csv"))
    assert codes.columns == ["Country", "Alpha-2 code"] and codes.count() == 1
    lines = readers.read_any(spark, str(tmp_path / "b.txt"))
    assert [tuple(r) for r in readers.parse_dictionary(lines, key_type="int").collect()] == [(1, "Air"), (2, "Sea")]
    with pytest.raises(ValueError, match="unknown file format"):
        readers.read_any(spark, str(tmp_path / "c.bin"))


def test_raw_labels_keep_blanks_and_quotes(spark):
    lines = spark.createDataFrame([("582 =  'MEXICO Air = Sea'",), ("'ALC'\t=\t'ALCAN, AK   '",)], "value string")
    raw = readers.parse_dictionary(lines, strip_label=False).collect()
    bare = readers.parse_dictionary(lines).collect()
    assert [r.label for r in raw] == ["  'MEXICO Air = Sea'", "\t'ALCAN, AK   '"]
    assert [tuple(r) for r in bare] == [("582", "MEXICO Air = Sea"), ("ALC", "ALCAN, AK")]


def test_shared_dir_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert workspace.shared_dir(spark) == configured
    assert workspace.new_dir(spark, "x").startswith(configured)


def test_stream_picks_up_new_files_only(spark, tmp_path):
    src, dst, check = (str(tmp_path / d) for d in ("src", "dst", "check"))
    batch = month(spark, 1, [1, 2])
    run = lambda: stream_files(spark, batch.schema, src, dst, check, partition_by=MONTH)
    batch.write.mode("append").parquet(src)
    run()
    run()
    assert counts(spark, dst) == {1: 2}
    month(spark, 2, [5]).write.mode("append").parquet(src)
    run()
    assert counts(spark, dst) == {1: 2, 2: 1}


def test_stream_merges_repeated_records(spark, tmp_path):
    src, dst, check = (str(tmp_path / d) for d in ("src", "dst", "check"))
    key = ["cicid", "year", "month"]
    for ids, note in (([1, 2], "first"), ([2, 3], "second")):
        batch = month(spark, 1, ids, note)
        batch.write.mode("append").parquet(src)
        stream_files(spark, batch.schema, src, dst, check, partition_by=MONTH, key=key)
    rows = {r.cicid: r.note for r in readers.read_table(spark, dst).collect()}
    assert rows == {1: "first", 2: "second", 3: "second"}


def test_first_batch_is_deduped_on_the_key(spark, tmp_path):
    path = str(tmp_path / "fact")
    batch = month(spark, 1, [1, 1, 2], "b").unionByName(month(spark, 1, [2], "a"))
    publish_incremental(batch, path, MONTH, key=["cicid", "year", "month"])
    assert {r.cicid: r.note for r in readers.read_table(spark, path).collect()} == {1: "b", 2: "a"}


def test_merge_lists_only_the_partitions_of_the_batch(spark, tmp_path):
    path = str(tmp_path / "fact")
    for m in (1, 2, 3):
        publish_incremental(month(spark, m, [1]), path, MONTH)
    old = partitions_of(month(spark, 2, [9]), MONTH, readers.read_table(spark, path))
    assert [r.month for r in old.collect()] == [2]
    assert re.search(r"PartitionFilters: \[[^]]*month#\d+ = 2", old._jdf.queryExecution().executedPlan().toString())


def test_many_partitions_are_joined(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "MAX_LITERAL_PARTITIONS", 1)
    path = str(tmp_path / "fact")
    for m in (1, 2, None):
        publish_incremental(month(spark, m, [1]), path, MONTH)
    batch = month(spark, 2, [9]).unionByName(month(spark, None, [9]))
    old = partitions_of(batch, MONTH, readers.read_table(spark, path))
    assert {r.month for r in old.collect()} == {2, None}


def test_a_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    hot = spark.range(0, 300_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(99).alias("c"), F.xxhash64("id").alias("v")
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "400KB")
    try:
        sinks.publish(hot, str(tmp_path / "t"), partition_by=["c"])
    finally:
        spark.conf.unset(size)
    files = lambda c: len(glob.glob(f"{tmp_path}/t/c={c}/*.parquet"))
    assert files(99) > 4
    assert sorted(files(c) for c in range(50))[25] == 1  # only those that share the hot value's shuffle partition are cut
    assert readers.read_table(spark, str(tmp_path / "t")).count() == 300_000


def test_rows_with_null_keys_all_stay(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = [(1, 2016, 1, "a"), (None, 2016, 1, "b"), (None, 2016, 1, "c"), (None, 2016, 1, "c"), (None, None, 1, "d")]
    batch = spark.createDataFrame(rows, "cicid int, year int, month int, note string")
    for _ in range(2):
        publish_incremental(batch, path, MONTH, key=["cicid", "year", "month"])
    found = sorted((r.note, r.cicid) for r in readers.read_table(spark, path).collect())
    assert found == [("a", 1), ("b", None), ("c", None), ("d", None)]


def test_text_partitions_keep_their_text(spark, tmp_path):
    path = str(tmp_path / "fact")
    batch = spark.createDataFrame([(1, "01"), (2, "02"), (3, "1"), (4, "2016-01-01"), (5, None)], "id int, st string")
    for _ in range(2):
        publish_incremental(batch, path, ["st"], key=["id", "st"])
    found = readers.read_table(spark, path, schema=batch.schema).collect()
    assert sorted(tuple(r) for r in found if r.st) == [(1, "01"), (2, "02"), (3, "1"), (4, "2016-01-01")] and len(found) == 5


def test_merged_batches_leave_no_work_table(spark, tmp_path):
    from pathlib import Path

    work = Path(spark.conf.get("spark.checkpoint.dir")) / "stellate"
    path = str(tmp_path / "fact")
    before = set(work.glob("batch-*"))
    for _ in range(2):
        publish_incremental(month(spark, 1, [1, 2, 3]), path, MONTH, key=["cicid"])
    assert set(work.glob("batch-*")) == before


def jobs_of(spark, work):
    """Spark jobs that a function starts."""
    group = f"count-{work.__name__}-{id(work)}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


@pytest.mark.parametrize("kind", ["csv", "parquet"])
def test_many_files_cost_as_many_jobs_as_one(spark, tmp_path, kind):
    def files(n):
        out = {}
        for i in range(n):
            path = f"{tmp_path}/{n}/file {i}.{kind}"
            rows = spark.createDataFrame([(i, f"row {i}"), (i + 1, None)], "`Some Id` int, name string").coalesce(1)
            rows.write.options(header=True).format(kind).save(path)
            out[f"0{i}"] = path
        return out

    counts, plans = [], []
    for n in (1, 10, 30):
        some, target = files(n), f"{tmp_path}/landed-{n}"

        def work():
            return sinks.land_files(spark, some, target)

        (landed,), jobs = jobs_of(spark, work)
        counts.append(jobs)
        plans.append(len(landed._jdf.queryExecution().optimizedPlan().toString().splitlines()))
        assert landed.columns == ["some_id", "name", "batch"] and landed.schema["batch"].dataType.simpleString() == "string"
        want = {(f"0{i}", str(i + k), f"row {i}" if not k else None) for i in range(n) for k in (0, 1)}
        assert {(r.batch, str(r.some_id), r.name) for r in landed.select("batch", "some_id", F.col("name")).collect()} == want
    assert len(set(plans)) == 1 and len(set(counts)) == 1


def test_landing_a_label_again_replaces_it(spark, tmp_path):
    write = lambda name, ids: spark.createDataFrame([(i,) for i in ids], "id int").write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
    write("a", [1, 2])
    write("b", [3])
    sinks.land_files(spark, {"a": f"{tmp_path}/a.parquet", "b": f"{tmp_path}/b.parquet"}, f"{tmp_path}/t")
    write("a2", [7])
    (again,) = sinks.land_files(spark, {"a": f"{tmp_path}/a2.parquet"}, f"{tmp_path}/t")
    assert [tuple(r) for r in again.collect()] == [(7, "a")]
    assert sorted(tuple(r) for r in readers.read_table(spark, f"{tmp_path}/t").collect()) == [(3, "b"), (7, "a")]


def test_files_with_another_header_are_refused(spark, tmp_path):
    for name, columns in (("a", "x int, y int"), ("b", "y int, x int")):
        spark.createDataFrame([(1, 2)], columns).write.options(header=True).csv(f"{tmp_path}/{name}.csv")
    with pytest.raises(Exception, match="(?i)header"):
        sinks.land_files(spark, {"a": f"{tmp_path}/a.csv", "b": f"{tmp_path}/b.csv"}, f"{tmp_path}/t")


def test_counts_while_writing(spark, tmp_path):
    """As many jobs as the plain write, and the same counts as a scan."""
    df = spark.range(1000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), (F.col("id") % 4).alias("p"), F.lit(None).cast("int").alias("x y"))

    def plain():
        return sinks.publish(df, f"{tmp_path}/a", partition_by=["p"])

    def counted():
        return sinks.publish(df, f"{tmp_path}/b", partition_by=["p"], observe_nulls=["k", "x y"])

    (_, jobs), (counts, more) = jobs_of(spark, plain), jobs_of(spark, counted)
    assert counts == {"rows": 1000, "k": 334, "x y": 1000}
    assert more == jobs


def test_rejected_cells(spark):
    df = spark.createDataFrame([("1", "2.0", "x"), ("a", None, " "), ("3.5", "1e2", "2016-01-01")], "a string, b string, c string")
    out = conform(df, {"a": "int", "b": "double", "c": "date", "missing": "int"}, rejects="lost")
    assert [(r.a, r.b, str(r.c)) for r in out.collect()] == [(1, 2.0, "None"), (None, None, "None"), (None, 100.0, "2016-01-01")]
    assert sorted(tuple(r) for r in rejected(out, "lost").collect()) == [("a", "3.5"), ("a", "a"), ("c", "x")]


def _files(path):
    return {f: os.path.getsize(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_a_late_piece_rewrites_its_buckets_only(spark, tmp_path):
    path, key = f"{tmp_path}/t", ["cicid"]
    whole = month(spark, 1, range(4000))
    publish_incremental(whole, path, MONTH, key=key, buckets=16)
    before, written = _files(path), {}
    assert len(before) == 16
    for n in (1, 4, 4000):
        publish_incremental(month(spark, 1, range(n), "late"), path, MONTH, key=key, buckets=16)
        after = _files(path)
        written[n] = sum(size for f, size in after.items() if f not in before)
        assert len(set(after) - set(before)) <= n
        before = after
    assert written[1] * 8 < written[4000] and written[4] * 3 < written[4000]
    rows = readers.read_table(spark, path)
    assert rows.count() == 4000 and rows.where("note = 'late'").count() == 4000


def test_buckets_keep_rows_without_key(spark, tmp_path):
    path = f"{tmp_path}/t"
    df = month(spark, 1, [None, None, 3, 3]).withColumn("note", F.when(F.col("cicid").isNull(), F.monotonically_increasing_id().cast("string")).otherwise("x"))
    df = spark.createDataFrame(df.collect(), df.schema)
    for _ in range(2):
        publish_incremental(df, path, MONTH, key=["cicid"], buckets=4)
    assert readers.read_table(spark, path).count() == 3
    with pytest.raises(ValueError):
        publish_incremental(df, path, MONTH, buckets=4)
