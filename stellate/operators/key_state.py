"""The key checks of a growing table, with only its changed partitions read again.

For each partition of the table a state holds the files that it was made from and a summary of its keys: every key's hash
with the number of its rows, and the rows that lack a part of their key. A check compares the files with those of the
state, reads the key columns of the partitions that differ, replaces their summaries and drops those of partitions that are
gone. Nulls and empty tables are counted from the summaries; so are repeated keys, wherever in the table their rows are.
Equal hashes only make a key suspect: suspects, few in a sound table, are looked up in the table itself, so the report is that
of ``quality.key_report``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import read_table
from ..sources.sinks import publish
from ..sources.workspace import store
from .joins import lookup_join
from .quality import _as_report, any_null, table_exists

PART = "part"


def _part(partition_by: Sequence[str]) -> Column:
    """The partition as text; a null differs from every value."""
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in partition_by])) if partition_by else F.lit("{}")


def _files(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """(part, files): a hash over the names, sizes and times of each partition's files. No data column is read."""
    names = [F.col(f"_metadata.{c}").alias(c) for c in ("file_path", "file_size", "file_modification_time")]
    each = df.select(_part(partition_by).alias(PART), F.xxhash64(*names).alias("file")).distinct()
    return each.groupBy(PART).agg(F.xxhash64(F.sort_array(F.collect_set("file"))).alias("files"))


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def _summary(df: DataFrame, keys: Sequence[str], partition_by: Sequence[str]) -> DataFrame:
    """(part, h, n): rows of each key's hash; ``h`` is null for keys with a null."""
    h = F.when(~any_null(keys), _hash(keys)).alias("h")
    return df.select(_part(partition_by).alias(PART), h).groupBy(PART, "h").agg(F.count(F.lit(1)).alias("n"))


def incremental_key_report(
    spark: SparkSession, path: str, keys: Sequence[str], state: str, partition_by: Sequence[str] = (), table: str = ""
) -> tuple[DataFrame, list[str]]:
    """Report of ``quality.key_report`` on a published table, and the partitions that were read for it (as JSON text).

    ``state`` is a folder for the check's own tables; without one, or with another list of keys in it, all is read. A check
    that dies is repeated for the same partitions by the next one, as the list of files is written last.
    """
    df = read_table(spark, path)
    sums, known = f"{state}/{'-'.join(keys)}/summaries", f"{state}/{'-'.join(keys)}/files"
    now = store(_files(df, partition_by), "key-files")  # one short row per partition
    if table_exists(spark, known):
        old = read_table(spark, known, schema=now.schema)
        touched = lookup_join(now, old, [PART, "files"], "left_anti")
    else:
        touched = now
    parts = sorted(r.part for r in touched.select(PART).collect())
    if parts:
        fresh = lookup_join(df.withColumn("__part", _part(partition_by)), touched.select(F.col(PART).alias("__part")), ["__part"], "left_semi")
        publish(_summary(fresh, keys, partition_by), sums, partition_by=[PART], dynamic=True)
    publish(now, known)
    if not table_exists(spark, sums):
        counted = spark.createDataFrame([(1, 0, 0)], "not_empty long, not_null long, unique long")
        return _as_report(counted, table, ["not_empty", "not_null", "unique"]), parts
    held = lookup_join(read_table(spark, sums, schema="h long, n long, part string"), now.select(PART), [PART], "left_semi")
    suspects = store(held.where("h IS NOT NULL").groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h"), "suspect-keys")
    repeated = F.lit(0)
    if not suspects.isEmpty():
        rows = df.where(~any_null(keys)).withColumn("__h", _hash(keys))
        met = rows.join(suspects.withColumnRenamed("h", "__h"), "__h", "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        repeated = F.lit(met.where("n > 1").count())
    counts = held.agg(
        F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).cast("bigint").alias("not_empty"),
        F.coalesce(F.sum(F.when(F.col("h").isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("not_null"),
        repeated.cast("bigint").alias("unique"),
    )
    return _as_report(counts, table, ["not_empty", "not_null", "unique"]), parts
