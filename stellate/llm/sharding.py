"""Reproducible shuffle into shards by a Feistel permutation of the global row numbers.

Rows are numbered 0 .. n - 1 in the order of (doc_id, size, crc32). A keyed Feistel network permutes the square domain of
the next even power of two, and walks along its cycle until it is below n again, which takes fewer than four steps on
average. The permuted number p gives shard ``p mod shards`` and slot ``p div shards``. So shards differ by at most one row
(law ``rows``), slots have no gaps, and the place of a row number, or the row number of a place, is computed from (n, seed)
alone, without a table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import store
from .order import running_start, sorted_by

ROUNDS = 8
_GOLDEN, _A, _B = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """Round function: 64 well-mixed bits of a half and the round's key."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(key) * _GOLDEN
        x = (x ^ (x >> np.uint64(30))) * _A
        x = (x ^ (x >> np.uint64(27))) * _B
        return x ^ (x >> np.uint64(31))


def _keys(seed: int) -> list[int]:
    return [int(k) for k in np.random.Generator(np.random.Philox(seed)).integers(1, 1 << 63, ROUNDS)]


def _half_bits(n: int) -> int:
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _network(x: np.ndarray, bits: int, keys: list[int], backwards: bool) -> np.ndarray:
    mask = np.uint64((1 << bits) - 1)
    left, right = x >> np.uint64(bits), x & mask
    for key in reversed(keys) if backwards else keys:
        if backwards:
            left, right = right ^ (_mix(left, key) & mask), left
        else:
            left, right = right, left ^ (_mix(right, key) & mask)
    return (left << np.uint64(bits)) | right


def permute(numbers: np.ndarray, n: int, seed: int, backwards: bool = False) -> np.ndarray:
    """Permuted numbers below ``n`` (or, backwards, the numbers that they come from)."""
    bits, keys = _half_bits(n), _keys(seed)
    out = _network(numbers.astype(np.uint64), bits, keys, backwards)
    outside = np.flatnonzero(out >= np.uint64(n))
    while len(outside):
        out[outside] = _network(out[outside], bits, keys, backwards)
        outside = outside[out[outside] >= np.uint64(n)]
    return out.astype(np.int64)


def numbered(df: DataFrame, *keys: str, name: str = "row_number") -> DataFrame:
    """Gapless global row numbers in the order of ``keys``; equal rows are numbered in any order.

    The sorted rows are written once to the shared folder with their place in their partition, so that the partitions'
    sizes, one small row each, hold for what is read back, also after a lost executor.
    """
    place = F.monotonically_increasing_id()
    placed = store(
        sorted_by(df, *keys).withColumns({"_part": F.shiftright(place, 33), "_place": place.bitwiseAND((1 << 33) - 1)}),
        "numbered",
    )
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_rows")).withColumn("_zero", F.lit(0))
    starts = running_start(sizes, "_part", "_zero", "_rows", "_start").select("_part", "_start")
    # one row for each partition of the sort: bounded by the job's partitions, whatever the rows
    return placed.join(F.broadcast(starts), "_part").withColumn(name, F.col("_start") + F.col("_place")).drop("_part", "_place", "_start")


def shard(df: DataFrame, shards: int, seed: int, keys: tuple[str, ...]) -> DataFrame:
    """``df`` with ``row_number``, ``shard`` (int) and ``slot`` (long, gapless from 0 in its shard).

    Nulls in ``keys`` come first, repeated rows get places of their own, an empty table stays empty. ``df`` should be
    narrow: it is sorted and written once. Its columns must not be called ``row_number``, ``shard`` or ``slot``.
    """
    rows = numbered(df, *keys)
    n = max(rows.count(), 1)

    @F.pandas_udf("long")
    def permuted(numbers):
        import pandas as pd

        return pd.Series(permute(numbers.to_numpy(), n, seed))

    place = rows.withColumn("_p", permuted("row_number"))
    return place.withColumns({"shard": (F.col("_p") % shards).cast("int"), "slot": F.floor(F.col("_p") / F.lit(shards)).cast("long")}).drop("_p")


def shard_documents(docs: DataFrame, shards: int = 24, seed: int = 2024) -> DataFrame:
    """Place of every document: doc_id, size, text_crc32, law, shard, slot, grown_shard, row_number.

    A null text counts as empty (size 8, crc32 0). ``grown_shard`` is null: under this law one more shard moves rows.
    """
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    narrow = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return shard(narrow, shards, seed, ("doc_id", "size", "text_crc32")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_number",
    )
