"""SimHash near-duplicates through an inverted index over the bytes of the fingerprints.

A fingerprint has eight positional bytes. Two fingerprints that differ in at most k bits differ in at most k bytes, so they
share at least ``8 - k`` positional bytes: the guaranteed minimum by which candidate pairs are counted out before their bits
are compared. A list for a single byte would hold 1/256 of all rows whatever their number, so that tallying from it would
grow with the square of the input. The lists are therefore joint: a list's key is three positional bytes, taken from either
half of the fingerprint (eight keys for each). Of any five bytes three lie in one half, so every pair that shares the minimum
of five meets in a list; there its shared bytes are tallied over all eight positions, pairs below the minimum are dropped,
and the rest is verified by the differing bits.

Equal fingerprints are one entry. A long list is cut into blocks, and pairs of blocks go to tasks of their own. From each
group of compared entries only the links of a spanning forest leave the task, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.joins import is_small
from ..sources.workspace import store
from .arrow import as_bytes, slices
from .columns import neutral
from .components import labelled

SEED = 42
SHINGLE = 3
MAX_BITS = 3
#: Entries of a list that are compared in one piece.
BLOCK = 4096


# ---- fingerprints ------------------------------------------------------------------------------------------------


def fingerprint_of(texts: list[bytes | None], shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """64-bit SimHash of each text: words between ASCII white space, A-Z lower-cased, shingles with their repeats."""
    from xxhash import xxh64_intdigest as xxh

    counts = np.zeros(len(texts), dtype=np.int64)
    values: list[int] = []
    for i, text in enumerate(texts):
        words = text.lower().split() if text else []
        if not words:
            continue
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        n = min(shingle, len(words))
        starts = np.append(0, ends[:-n] + 1)
        own = [xxh(line[a:b], seed) for a, b in zip(starts.tolist(), ends[n - 1 :].tolist())]
        counts[i] = len(own)
        values += own
    out = np.zeros(len(texts), dtype=np.uint64)
    if not values:
        return out
    some = np.flatnonzero(counts)
    starts = np.append(0, np.cumsum(counts[some])[:-1])
    bits = np.unpackbits(np.array(values, dtype=">u8").view(np.uint8)).reshape(-1, 64)
    ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
    high = 2 * ones > counts[some][:, None]
    out[some] = np.packbits(high, axis=1).view(">u8").ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """All columns of ``docs`` and ``_fp`` (long, the 64 bits as they are). Null and empty texts: 0."""
    rest = docs.schema.fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            fp = fingerprint_of(as_bytes(batch.column("text")), shingle, seed).view(np.int64)
            columns = [batch.column(f.name) for f in rest] + [pa.array(fp)]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in rest] + ["_fp"])

    return docs.mapInArrow(run, StructType([*rest, StructField("_fp", LongType())]))


# ---- links -------------------------------------------------------------------------------------------------------


def masks() -> list[int]:
    """Three positional bytes of either half, as 64-bit masks (signed)."""
    out = []
    for half in (range(4), range(4, 8)):
        for three in combinations(half, 3):
            mask = sum(0xFF << (8 * b) for b in three)
            out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def shared_bytes(difference: np.ndarray) -> np.ndarray:
    """Positional bytes that two fingerprints share, from their exclusive or."""
    low = np.uint64(0x7F7F7F7F7F7F7F7F)
    unlike = (((difference & low) + low) | difference) & ~low
    return 8 - np.bitwise_count(unlike).astype(np.int64)


def forest(group: np.ndarray, values: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest over the pairs within each group (sorted) that differ in at most ``max_bits`` bits."""
    n = len(values)
    root = np.arange(n)
    left: list[int] = []
    right: list[int] = []

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = int(root[i])
        return i

    at, step = np.arange(n - 1), 1
    at = at[group[at] == group[at + 1]] if n > 1 else at
    while len(at):
        difference = values[at] ^ values[at + step]
        near = at[shared_bytes(difference) >= 8 - max_bits]
        near = near[np.bitwise_count(values[near] ^ values[near + step]) <= max_bits]
        if len(near):
            near = near[root[near] != root[near + step]]
            for i in near.tolist():
                a, b = find(i), find(i + step)
                if a != b:
                    root[max(a, b)] = min(a, b)
                    left.append(i)
                    right.append(i + step)
            if len(near):
                while True:
                    up = root[root]
                    if (up == root).all():
                        break
                    root = up
        step += 1
        at = at[at + step < n]
        at = at[group[at] == group[at + step]]
    return values[np.array(left, dtype=np.int64)], values[np.array(right, dtype=np.int64)]


def _compare(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, value = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            group = np.append(group, batch.column("g").to_numpy())
            value = np.append(value, batch.column("_fp").to_numpy().view(np.uint64))
            done = int(np.searchsorted(group, group[-1]))  # the last group may go on in the next batch
            if done:
                yield links(group[:done], value[:done])
                group, value = group[done:], value[done:]
        if len(group):
            yield links(group, value)

    def links(group: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
        a, b = forest(group, value, max_bits)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return run


def link_forest(values: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Links ``a``, ``b`` that connect what is connected among the distinct fingerprints ``_fp``. It reads them twice."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the lists hold pairs with at most three differing bits")
    lists: list[Column] = [F.xxhash64(F.lit(i), F.col("_fp").bitwiseAND(F.lit(m))) for i, m in enumerate(masks())]
    entries = values.select("_fp", F.explode(F.array(*lists)).alias("key"))
    long_lists = entries.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > block)
    blocks = F.coalesce(F.ceil(F.col("n") / block), F.lit(1))
    dealt = (
        entries.join(long_lists, "key", "left")
        .withColumn("blocks", blocks.cast("long"))
        .withColumn("own", F.pmod(F.xxhash64("_fp", F.lit(1)), "blocks"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("g"), "_fp")
    )
    return dealt.repartition("g").sortWithinPartitions("g").mapInArrow(_compare(max_bits), "a long, b long")


# ---- operator ----------------------------------------------------------------------------------------------------


def _components(printed: DataFrame, key: str, max_bits: int) -> DataFrame:
    """``_fp``, ``component_id`` and ``_root`` (the least fingerprint) for every distinct fingerprint of a stored table."""
    values = store(printed.groupBy("_fp").agg(F.min(key).alias("_least")), "fingerprint-values")
    return labelled(values, "_fp", "_least", link_forest(values, max_bits)).select("_fp", "component_id", "_root")


def near_duplicates(docs: DataFrame, key: str = "doc_id", shingle: int = SHINGLE, max_bits: int = MAX_BITS, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs`` (with ``text``): ``key``, ``fingerprint`` (16 hex digits) and ``component_id``, the least
    ``key`` among all documents reachable by links, the row's own included.

    Null and empty texts have fingerprint zero and are linked like others. Rows without a key take part; only a component
    without any key has a null id. Repeated rows stay. An empty table gives no rows. Other columns don't matter.
    """
    printed = store(fingerprints(docs.select(key, "text"), shingle, seed).drop("text"), "fingerprints")
    digits = F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint")
    return printed.join(_components(printed, key, max_bits), "_fp").select(key, digits, "component_id")


def deduplicate(docs: DataFrame, key: str = "doc_id", shingle: int = SHINGLE, max_bits: int = MAX_BITS, seed: int = SEED) -> DataFrame:
    """One row of each group of near-duplicates, with all columns of ``docs``: that with the least ``key`` (null last),
    and of rows with the same key any one. An empty table gives no rows."""
    own, back = neutral(docs, key, "text")
    printed = store(fingerprints(own, shingle, seed).withColumn("_row", F.monotonically_increasing_id()), "fingerprints")
    order = F.struct(F.col(key).isNull(), F.col(key), F.col("_row"))
    known = _components(printed.select(key, "_fp"), key, max_bits)
    grouped = printed.select(key, "_fp", "_row").join(known, "_fp").groupBy("_root")
    kept = grouped.agg(F.min(order).alias("_first")).select("_first._row")
    return back(_rows_kept(printed, kept))


def _rows_kept(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """The ``rows`` whose number ``_row`` is among ``kept``. Numbers of a task follow each other, so those kept are marked by
    the bits of one long for 64 of them, and the texts need not be shuffled to meet them."""
    bit = F.col("_row").bitwiseAND(F.lit(63)).cast("int")
    marks = kept.groupBy(F.shiftright("_row", 6).alias("_word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("_bits"))
    marks = store(marks, "kept-rows")
    marked = rows.join(F.broadcast(marks) if is_small(marks) else marks, F.shiftright("_row", 6) == F.col("_word"))
    return marked.where(F.getbit("_bits", bit) == 1).select(rows.columns)
