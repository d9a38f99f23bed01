"""Work that may be repeated: what is still pending, and publishing that changes nothing the second time."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..sources.readers import read_table
from ..sources.sinks import publish
from ..sources.workspace import discard, new_dir
from .aggregates import one_per_key, union_all
from .joins import is_small, lookup_join
from .quality import table_exists

MAX_LITERAL_PARTITIONS = 500
BUCKET = "key_bucket"


def pending(candidates: DataFrame, published: DataFrame, on: Sequence[str], small: bool | None = None) -> DataFrame:
    """Candidate rows whose key is not yet published."""
    return lookup_join(candidates, published.select(*on).distinct(), on, "left_anti", small)


def _one_of(cols: Sequence[str], values: Sequence[Row]) -> Column:
    """True for the given combinations of values: the last column is listed per combination of the others."""
    *heads, last = cols
    lists = defaultdict(set)
    for r in values:
        lists[tuple(r[c] for c in heads)].add(r[last])

    def group(head: tuple, tails: set) -> Column:
        known = [t for t in tails if t is not None]
        hit = F.col(last).isin(known) if known else F.lit(False)
        if None in tails:
            hit = hit | F.col(last).isNull()
        return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(heads, head)], hit)

    return reduce(lambda a, b: a | b, [group(h, t) for h, t in lists.items()])


def partitions_of(df: DataFrame, partition_by: Sequence[str], old: DataFrame) -> DataFrame:
    """The rows of ``old`` in the partitions that occur in ``df``; a null counts as a value.

    Up to ``MAX_LITERAL_PARTITIONS`` partitions become literals, so the scan lists those directories only.
    """
    touched = df.select(*partition_by).distinct()
    values = touched.limit(MAX_LITERAL_PARTITIONS + 1).collect()
    if not values:
        return old.limit(0)
    if len(values) <= MAX_LITERAL_PARTITIONS:
        return old.where(_one_of(partition_by, values))
    same = [old[c].eqNullSafe(touched[c]) for c in partition_by]
    return old.join(F.broadcast(touched) if is_small(touched) else touched, same, "left_semi")


def merge_with_published(
    df: DataFrame, path: str, partition_by: Sequence[str], key: Sequence[str], order_by: Sequence[Column | str]
) -> DataFrame:
    """The batch together with what its partitions already hold, one row per key; on equal keys the batch wins.

    Rows with a null in their key all stay; one that is published again adds nothing. Only the partitions that occur in the
    batch are read, under the batch's types. The batch is read twice.
    """
    published = read_table(df.sparkSession, path, schema=df.schema) if table_exists(df.sparkSession, path) else None
    return merged(df, published, partition_by, key, order_by)


def merged(
    df: DataFrame, published: DataFrame | None, partition_by: Sequence[str], key: Sequence[str], order_by: Sequence[Column | str]
) -> DataFrame:
    """``merge_with_published`` for a table that is read already; ``None`` if there is none."""
    if published is None:
        return one_per_key(df, key, order_by)
    kept = (partitions_of(df, partition_by, published) if partition_by else published).select(*df.columns)
    both = union_all(df.withColumn("__age", F.lit(0)), kept.withColumn("__age", F.lit(1)))
    return one_per_key(both, key, ["__age", *order_by]).drop("__age")


def _bucketed(df: DataFrame, key: Sequence[str], buckets: int) -> DataFrame:
    """Rows with a null in their key have the bucket of all their columns, so they are spread and repeats still meet."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    place = F.when(whole, F.xxhash64(*[F.col(k) for k in key])).otherwise(F.xxhash64(*df.columns))
    return df.withColumn(BUCKET, F.pmod(place, F.lit(buckets)).cast("int"))


def publish_incremental(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    key: Sequence[str] | None = None,
    order_by: Sequence[Column | str] | None = None,
    stored: bool = False,
    buckets: int | None = None,
    **options,
) -> None:
    """Publish whole partitions (months): those in the batch are replaced, all others stay, so a repeat adds nothing.

    With a ``key`` a month may arrive in pieces: the batch is merged with the published month, and one row per key is
    kept, the first in ``order_by`` (default: by all other columns); rows with a null in their key are all kept. The batch
    is written to the shared folder for that and removed again, unless it is cheap to read twice (``stored``). Old files
    are removed only when the new ones are complete, so a job that dies can be run again.

    ``buckets`` cuts each partition into that many directories by the hash of the key, the last partition column
    ``BUCKET`` of the table: a small late piece then reads and rewrites the buckets of its keys, not whole months. The number
    is to stay the same for all pieces of a table.
    """
    spark, work = df.sparkSession, None
    if buckets:
        if not key:
            raise ValueError("buckets are cut by the key, so there has to be one")
        df, partition_by = _bucketed(df, key, buckets), [*partition_by, BUCKET]
    if key:
        order = order_by or [c for c in df.columns if c not in key and c != BUCKET] or list(key)
        if not stored and table_exists(spark, path):
            work = new_dir(spark, "batch")
            df.write.parquet(work)
            df = spark.read.schema(df.schema).parquet(work)
        df = merge_with_published(df, path, partition_by, key, order)
    publish(df, path, mode="overwrite", partition_by=partition_by, dynamic=True, **options)
    if work:
        discard(spark, work)
