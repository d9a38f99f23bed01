"""A bounded sample of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import store


def labelled(docs: DataFrame, labels: DataFrame, key: str, label: str, rows: int, usable: Column | None = None) -> DataFrame:
    """``key`` and ``label`` (0 or 1) of about ``rows`` labelled documents at most, chosen by the hash of their keys.

    A repeated label counts once, the greater one. An id that several documents have says nothing about either of them and is
    left out, so that there is one document for each row. The result is stored; it has two numbers a row and may be
    broadcast.
    """
    given = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
    given = given.where(F.col("key").isNotNull() & F.col("label").isin(0, 1))
    given = given.where(usable) if usable is not None else given
    given = given.groupBy("key").agg(F.max("label").alias("label"))
    share = min(1.0, rows / max(given.count(), 1))
    chosen = store(given.where(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))), "chosen-labels")
    there = docs.select(F.col(key).alias("key")).join(F.broadcast(chosen), "key")
    once = there.groupBy("key").agg(F.count("*").alias("n"), F.min("label").alias("label")).where("n = 1")
    return store(once.select("key", "label"), "labels")
