"""Benchmark decontamination with an FM-index per shard of training documents.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. A benchmark item is cut into windows of 13
consecutive words (an item of fewer is one window). Documents are gathered into shards of a bounded number of words in the
task that scans them, without a shuffle. A word that no window has can't be part of an occurrence, so such words separate,
and a run of the others that is shorter than the shortest window is left out; what remains is indexed. All windows are
searched backwards at once, their occurrences located by the sampled positions, and merged into spans to remove.

The benchmark is read in blocks of a bounded size, so that it may be larger than the driver's or a task's memory: documents
pass one block after the other and carry the spans and items found so far, written to the shared folder in between, so that a
task never holds more than one block. Words are searched by 64-bit hashes; the words of each occurrence are then compared by
their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from ..sources.workspace import discard, new_dir
from .arrow import offsets, ragged_take, slices
from .columns import neutral
from .fmindex import FMIndex
from .words import Table, buffer_of, hashes, runs

WINDOW = 13
#: Words of documents in one index, give or take a batch.
SHARD_WORDS = 1 << 20
#: Text of benchmark items in one block.
BLOCK_BYTES = 8 << 20
#: Words compared by their bytes at a time.
COMPARED = 1 << 16

_SPAN = StructType([StructField("start", LongType()), StructField("end", LongType())])
_STATE = [StructField("_hits", ArrayType(_SPAN)), StructField("_items", ArrayType(StringType()))]
FOUND = [
    StructField("n_words", LongType()),
    StructField("n_hit", LongType()),
    StructField("items", ArrayType(StringType())),
    StructField("spans", ArrayType(_SPAN)),
]

IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@dataclass
class Words:
    """Words of some texts: their hashes, where they lie in ``data`` (lower-cased bytes of all texts), the number of the first
    word of each text, and where each text's bytes begin."""

    hashed: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    data: np.ndarray
    at: np.ndarray

    @classmethod
    def joined(cls, parts: list["Words"]) -> "Words":
        words, size = offsets(np.array([len(p.hashed) for p in parts])), offsets(np.array([len(p.data) for p in parts]))
        shifted = lambda of, by: np.concatenate([of(p) + b for p, b in zip(parts, by)])
        return cls(
            np.concatenate([p.hashed for p in parts]), shifted(lambda p: p.start, size), shifted(lambda p: p.end, size),
            np.append(shifted(lambda p: p.first[:-1], words), words[-1]), np.concatenate([p.data for p in parts]), np.append(shifted(lambda p: p.at[:-1], size), size[-1]),
        )


def words_of(column: pa.Array) -> Words:
    data, at = buffer_of(column)
    data = LOWER[data]
    start, end = runs(IS_WORD[data])
    return Words(hashes(data, start, end), start, end, np.searchsorted(start, at), data, at)


def same_bytes(data: np.ndarray, start: np.ndarray, end: np.ndarray, other: np.ndarray, other_start: np.ndarray, other_end: np.ndarray) -> np.ndarray:
    """Whether ``data[start:end]`` and ``other[other_start:other_end]`` are equal, for each word; none is empty."""
    out = end - start == other_end - other_start
    equal = np.flatnonzero(out)
    for i in range(0, len(equal), COMPARED):
        rows = equal[i : i + COMPARED]
        size = end[rows] - start[rows]
        differ = data[ragged_take(start[rows], size)] != other[ragged_take(other_start[rows], size)]
        out[rows] = np.add.reduceat(differ, offsets(size)[:-1], dtype=np.int64) == 0
    return out


@dataclass
class Phrases:
    """Distinct windows of some benchmark items, in numbers from 1 for the words that they have."""

    vocabulary: np.ndarray
    data: np.ndarray  # bytes of the vocabulary's words, one after the other
    word_at: np.ndarray
    patterns: np.ndarray
    lengths: np.ndarray
    owners: np.ndarray  # items of each window, one after the other
    owner_at: np.ndarray
    items: list[str]

    @classmethod
    def none(cls, window: int) -> "Phrases":
        whole, one = np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64)
        return cls(np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint8), one, np.zeros((0, window), dtype=np.int32), whole, whole, one, [])


def phrases(items: list[tuple[str, str | None]], window: int = WINDOW) -> Phrases | None:
    """None if no item has a word."""
    words = words_of(pa.array([t for _, t in items], pa.large_string()))
    if not len(words.hashed):
        return None
    vocabulary, place, numbers = np.unique(words.hashed, return_index=True, return_inverse=True)
    size = words.end[place] - words.start[place]
    data, word_at = words.data[ragged_take(words.start[place], size)], offsets(size)
    if not same_bytes(words.data, words.start, words.end, data, word_at[numbers], word_at[numbers + 1]).all():
        raise ValueError("two different words of the benchmark have the same hash")
    names = sorted({name for name, _ in items})
    index = {name: i for i, name in enumerate(names)}
    item = np.array([index[name] for name, _ in items], dtype=np.int64)
    count = np.diff(words.first)
    windows = np.where(count > 0, np.maximum(1, count - window + 1), 0)
    start = ragged_take(words.first[:-1], windows)
    length = np.repeat(np.minimum(count, window), windows)
    patterns = np.zeros((len(start), window), dtype=np.int32)
    for k in range(window):
        there = length > k
        patterns[there, k] = numbers[start[there] + k] + 1
    # rows of different length differ, as 0 is no word
    row = patterns.view(np.dtype((np.void, patterns.itemsize * window))).ravel()
    _, one, which = np.unique(row, return_index=True, return_inverse=True)
    pairs = np.unique(which.astype(np.int64) * len(names) + np.repeat(item, windows))
    owner_at = np.searchsorted(pairs // len(names), np.arange(len(one) + 1))
    return Phrases(vocabulary, data, word_at, patterns[one], length[one].astype(np.int64), pairs % len(names), owner_at, names)


def find(known: Phrases, table: Table, words: Words) -> tuple[np.ndarray, np.ndarray, list[set[int]]]:
    """Words of a shard inside an occurrence (as starts and ends of merged runs of word numbers), and each text's items."""
    numbers, first = table.find(words.hashed) + 1, words.first
    none: list[set[int]] = [set() for _ in range(len(first) - 1)]
    if not len(known.lengths):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), none
    cut = np.zeros(len(numbers) + 1, dtype=bool)  # where a text begins
    cut[first] = True
    start, end = runs(numbers > 0, cut[:-1])
    long = end - start >= known.lengths.min()
    start, end = start[long], end[long]
    if not len(start):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), none
    # the runs one after the other, a zero after each
    size = end - start + 1
    to = offsets(size)
    shift = np.repeat(start - to[:-1], size)
    place = np.arange(to[-1]) + shift  # number of the word at each position
    seq = numbers[np.minimum(place, len(numbers) - 1)]
    seq[to[1:] - 1] = 0
    index = FMIndex(seq.astype(np.int64), len(known.vocabulary) + 1)
    low, high = index.search(known.patterns, known.lengths)
    at, which = index.locate(low, high)
    at = place[at]
    # an occurrence stands if its words have the bytes of the window's
    inside = np.unique(ragged_take(at, known.lengths[which]))
    own = numbers[inside] - 1
    wrong = np.zeros(len(numbers) + 1, dtype=np.int64)
    wrong[inside + 1] = ~same_bytes(words.data, words.start[inside], words.end[inside], known.data, known.word_at[own], known.word_at[own + 1])
    wrong = np.cumsum(wrong)
    true = wrong[at + known.lengths[which]] == wrong[at]
    at, which = at[true], which[true]
    edge = np.bincount(at, minlength=len(numbers) + 1) - np.bincount(at + known.lengths[which], minlength=len(numbers) + 1)
    hit_start, hit_end = runs(np.cumsum(edge)[:-1] > 0, cut[:-1])
    text = np.searchsorted(first, at, side="right") - 1
    for t, w in zip(*np.unique(np.stack([text, which]), axis=1).tolist()) if len(at) else ():
        none[t].update(known.owners[known.owner_at[w] : known.owner_at[w + 1]].tolist())
    return hit_start, hit_end, none


def _pass(rest: list[str], known: Phrases, last: bool, shard_words: int):
    """Documents past one block of the benchmark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table.of(known.vocabulary)
        held: list[tuple] = []

        def flush() -> Iterator[pa.RecordBatch]:
            words = Words.joined([own for _, own in held])
            first, base = words.first, words.at
            start, end, items = find(known, table, words)
            text = np.searchsorted(first, start, side="right") - 1
            upto = np.searchsorted(text, np.arange(len(first)))
            row = 0
            for batch, own_words in held:
                n = batch.num_rows
                hits, names, counts, spans = [], [], [], []
                before_hits, before_items = batch.column("_hits").to_pylist(), batch.column("_items").to_pylist()
                for k in range(n):
                    a, b = upto[row + k], upto[row + k + 1]
                    own = list(zip((start[a:b] - first[row + k]).tolist(), (end[a:b] - first[row + k]).tolist()))
                    merged = _merge(own, [(h["start"], h["end"]) for h in before_hits[k]])
                    hits.append([{"start": x, "end": y} for x, y in merged])
                    counts.append(sum(y - x for x, y in merged))
                    f, to = first[row + k], base[row + k]
                    spans.append([{"start": int(words.start[f + x] - to), "end": int(words.end[f + y - 1] - to)} for x, y in merged])
                    names.append(sorted({*before_items[k], *(known.items[i] for i in items[row + k])}))
                row += n
                if last:
                    made = [pa.array(np.diff(own_words.first)), pa.array(counts, pa.int64()), pa.array(names, pa.list_(pa.string())), pa.array(spans, _spans())]
                    fields = [f.name for f in FOUND]
                else:
                    made = [pa.array(hits, _spans()), pa.array(names, pa.list_(pa.string()))]
                    fields = ["_hits", "_items"]
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in rest] + made, rest + fields)
            held.clear()

        for batch in slices(batches, "text"):
            held.append((batch, words_of(batch.column("text"))))
            if sum(len(own.hashed) for _, own in held) >= shard_words:
                yield from flush()
        if held:
            yield from flush()

    return run


def _spans() -> pa.DataType:
    return pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _merge(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    if not b:
        return a
    out: list[tuple[int, int]] = []
    for x, y in sorted(a + b):
        if out and x <= out[-1][1]:
            out[-1] = (out[-1][0], max(y, out[-1][1]))
        else:
            out.append((x, y))
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS, block_bytes: int = BLOCK_BYTES, share: int = 20) -> DataFrame:
    """``docs`` (with ``text``) and, for each row, ``n_words``, ``n_hit`` (words inside an occurrence of a window),
    ``items`` (ids of the items that have one, as strings, sorted), ``spans`` (merged, as bytes of the UTF-8 text) and
    ``contaminated`` (``n_hit > 0`` and ``share * n_hit >= n_words``).

    A null text has no words. Rows with repeated or null ids are rows like others. Items with the same id are one item, a
    null id is the empty string; items without words are found nowhere. Columns of ``docs`` with a name given here are
    replaced.
    """
    made = [f.name for f in FOUND + _STATE] + ["contaminated"]
    now = docs.drop(*made)
    rest = now.schema.fields
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    now = now.withColumns({"_hits": F.array().cast(ArrayType(_SPAN)), "_items": F.array().cast("array<string>")})
    before = None
    for b in range(blocks):
        # one block of the stated size is on the driver, and in a task, at a time
        known = phrases([tuple(r) for r in items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).collect()], window)
        last = b == blocks - 1
        if known is None and not last:
            continue
        now = now.mapInArrow(_pass([f.name for f in rest], known or Phrases.none(window), last, shard_words), StructType([*rest, *(FOUND if last else _STATE)]))
        if not last:
            path = new_dir(docs.sparkSession, "contamination")
            schema = now.schema
            now.write.parquet(path)
            now = docs.sparkSession.read.schema(schema).parquet(path)
            if before:
                discard(docs.sparkSession, before)
            before = path
    return now.withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` that are not contaminated, with its columns.

    Null and empty texts have no words and stay; very long ones are searched whole; repeated rows and ids stay or go each. An
    empty benchmark removes nothing, an empty table gives no rows. Columns may have any name.
    """
    plain, back = neutral(docs, "text")
    return back(contamination(plain, benchmark, **options).where(~F.col("contaminated")))
