"""Parquet sinks."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from ..operators.shape import sanitise_columns
from .readers import read_files, read_table
from .workspace import discard, new_dir

#: Up to so many files are gathered from the shared folder; the rows of more are dealt by a shuffle.
MAX_GATHERED = 16


def _free_name(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def _gathered(df: DataFrame, n_files: int, work: str) -> DataFrame:
    """``df`` in ``n_files`` partitions of rows dealt in turn. The tasks of ``df`` write their rows below ``work``, a folder for
    each partition, where its task reads them by columns: no task fetches a share of the table by shuffle."""
    spark, file = df.sparkSession, _free_name(df, "file_number")
    turn = F.pmod(F.monotonically_increasing_id() + F.spark_partition_id(), F.lit(n_files)).cast("int")
    df.withColumn(file, turn).write.partitionBy(file).parquet(work)
    stored = spark.read.schema(StructType([*df.schema, StructField(file, IntegerType())])).parquet(work)
    own = [stored.where(F.col(file) == i).drop(file).coalesce(1) for i in range(n_files)]
    # Spark makes one partition of several frames that all have one; a frame without partitions among them keeps them apart
    return reduce(DataFrame.union, own, stored.where(F.col(file) == -1).drop(file))


def _in_whole_chunks(df: DataFrame, rows: int, work: str) -> DataFrame:
    """``df`` dealt to tasks that hold whole chunks of so many rows each, but for the last chunk. It is written below ``work``
    for that, with each row's number in its task, so that the rows before it can be counted."""
    spark, part, row, chunk = df.sparkSession, *(_free_name(df, c) for c in ("part_number", "row_number", "chunk_number"))
    number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    df.withColumns({part: F.spark_partition_id(), row: number}).write.parquet(work)
    stored = spark.read.schema(StructType([*df.schema, StructField(part, IntegerType()), StructField(row, LongType())])).parquet(work)
    # one short row for each task that wrote
    counts = stored.groupBy(part).agg(F.count(F.lit(1)).alias(chunk))
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(part, F.coalesce(F.sum(chunk).over(earlier), F.lit(0)).alias(chunk))
    dealt = stored.join(F.broadcast(before), part).withColumn(chunk, F.floor((F.col(chunk) + F.col(row)) / rows))
    return dealt.repartition(chunk).drop(part, row, chunk)


def publish(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    n_files: int | None = None,
    cluster_by: Sequence[str] | None = None,
    sort_within: Sequence[str] = (),
    max_records_per_file: int | None = None,
    dynamic: bool = False,
    observe_nulls: Sequence[str] | None = None,
) -> dict[str, int] | None:
    """Write a table as Parquet.

    * ``cluster_by`` brings equal values together before the write; by default those of ``partition_by``, so that not
      every task writes into every directory. It is a *rebalance*: Spark cuts a group that is too big for one task into
      several and packs small ones together, so file sizes stay even under skew. ``()`` writes rows where they are.
    * ``n_files`` spreads rows round-robin over that many tasks. One file suits reference tables only. The rows are written
      to the shared folder for that and removed again.
    * ``max_records_per_file`` cuts a task's file into several. With one file asked for (and no partitions) there are as many
      as the rows need, all full but for one, and as many tasks as usual write them.
    * ``sort_within`` sorts inside each file, after the rows were placed. No global order is promised.
    * ``dynamic`` replaces only the partitions that occur in ``df``.
    * ``observe_nulls`` counts while the rows are written, without another scan, and returns ``rows`` and, for each of the
      given columns (none of them called ``rows``), its nulls. The last stage counts, so a shuffle that is repeated after a lost executor counts once.
    """
    if n_files and cluster_by:
        raise ValueError("choose n_files or cluster_by")
    work = None
    if n_files and (n_files == 1 and max_records_per_file and not partition_by):
        work = new_dir(df.sparkSession, "chunks")
        df = _in_whole_chunks(df, max_records_per_file, work)
    elif n_files and n_files <= MAX_GATHERED:
        work = new_dir(df.sparkSession, "files")
        df = _gathered(df, n_files, work)
    elif n_files:
        df = df.repartition(n_files)
    elif clusters := list(partition_by if cluster_by is None else cluster_by):
        df = df.hint("rebalance", *clusters)
    if sort_within:
        df = df.sortWithinPartitions(*partition_by, *sort_within)
    seen = Observation()
    if observe_nulls is not None:
        nulls = [F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(f"n{i}") for i, c in enumerate(observe_nulls)]
        df = df.observe(seen, F.count(F.lit(1)).alias("all"), *nulls)
    writer = df.write.mode(mode)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    if work:
        discard(df.sparkSession, work)
    if observe_nulls is None:
        return None
    got = seen.get
    return {"rows": got["all"]} | {c: got[f"n{i}"] for i, c in enumerate(observe_nulls)}


def publish_together(tables: Mapping[str, Callable[[], DataFrame]], **options) -> None:
    """Publish independent tables (path -> what makes the table) at the same time, so that the jobs of one use the cores that
    those of another leave idle. The first that fails raises when all have ended."""
    with ThreadPoolExecutor(max(1, len(tables))) as pool:
        # each thread takes over the local properties of this one
        jobs = [pool.submit(inheritable_thread_target(lambda path=path, make=make: publish(make(), path, **options))) for path, make in tables.items()]
    for job in jobs:
        job.result()


def publish_reference(df: DataFrame, path: str) -> None:
    """Publish a reference list or map for later jobs, replacing the previous one."""
    publish(df.hint("rebalance"), path)


def load_reference(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path)


def land(df: DataFrame, target: str, batch: str | None = None, n_files: int | None = None) -> DataFrame:
    """Store a raw scan as Parquet under sanitised names and return what was stored.

    Without ``batch`` the target is replaced. With it, the batch gets its own directory below the target: others are
    kept, landing a batch again replaces it, and only this batch is returned.
    """
    path = target if batch is None else f"{target.rstrip('/')}/batch={batch}"
    publish(sanitise_columns(df), path, n_files=n_files)
    return read_table(df.sparkSession, path)


def _plain(uri: str) -> str:
    """A URI with one slash after its scheme, however its authority is written."""
    return re.sub(r"^([a-z0-9]+):/+", r"\1:/", uri)


def _qualified(spark: SparkSession, path: str) -> str:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return _plain(store.makeQualified(hadoop).toUri().toString()).rstrip("/")


def _label_of(file: str, roots: Mapping[str, str]) -> str | None:
    """Label of the longest root that is the file or a folder above it."""
    at = file
    while at and at not in roots:
        at = at.rpartition("/")[0]
    return roots.get(at)


def land_files(spark: SparkSession, files: Mapping[str, str], target: str, batch: str = "batch", fmt: str | None = None, **options) -> list[DataFrame]:
    """Store many raw files (label -> file or folder) as Parquet under sanitised names, one partition ``batch`` per label.

    The files of a format are read by one scan and written by one job, however many they are; the label of a row comes from
    the file that holds it. Nothing is shuffled. Files of a format share their columns: Parquet schemas are merged, delimited
    files whose header differs from the first one's are refused. Landing a label again replaces its rows (unless it has none
    now). Returns what was landed for each format, with the column ``batch``.
    """
    kinds: dict[str, dict[str, str]] = {}
    for label, path in files.items():
        kinds.setdefault(fmt or os.path.splitext(path.rstrip("/"))[1].lower(), {})[label] = path
    landed = []
    for some in kinds.values():
        scan = read_files(spark, list(some.values()), fmt, **options)
        clean = sanitise_columns(scan)
        if batch in clean.columns:
            raise ValueError(f"the files have a column {batch!r} already")
        roots = {_qualified(spark, path): label for label, path in some.items()}
        labels = [(name, _label_of(_plain(name), roots)) for name in scan.inputFiles()]
        # one short row for each file of the scan, which the driver has listed anyway
        known = spark.createDataFrame([(_plain(n), label) for n, label in labels], f"__file string, `{batch}` string")
        where = F.regexp_replace(F.col("_metadata.file_path"), "^([a-z0-9]+):/+", "$1:/")
        rows = scan.withColumn("__file", where).join(F.broadcast(known), "__file", "left").drop("__file")
        publish(rows.toDF(*clean.columns, batch), target, partition_by=[batch], cluster_by=(), dynamic=True)
        schema = StructType([*clean.schema, StructField(batch, StringType())])
        landed.append(read_table(spark, target, schema=schema).where(F.col(batch).isin(list(some))))
    return landed
