"""Vector best-fit packing of token ids into sequences.

A sequence has three capacities: tokens, documents, and attention cost (the sum of the squared lengths of its pieces, as
attention stays inside a document). Pieces come longest first; each goes to the open sequence that can take it under every
capacity and fits best: by the least weighted norm of what would remain, or by the greatest weighted dot product of the
piece's demand and what is free.

Only lengths are packed. They are dealt in groups of a bounded number of pieces, which are packed one by one, so that a task
never holds more than a group; each group leaves less than one sequence open on average.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import store
from .arrow import offsets, slices
from .tokens import default_vocabulary, encoder

TOKENS = 2048
END_ID = 0
GROUP = 16_384
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pack(
    lengths: np.ndarray,
    tokens: int = TOKENS,
    documents: int | None = None,
    cost: int | None = None,
    by: str = "norm",
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05),
) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece. No capacity is ever exceeded; a piece alone may always have a sequence.

    ``documents`` and ``cost`` None: as many as the tokens allow.
    """
    if by not in ("norm", "dot"):
        raise ValueError(f"unknown rule {by}")
    documents, cost = documents or tokens, cost or tokens * tokens
    n = len(lengths)
    scale = np.array([tokens, documents, cost], dtype=np.float64)
    w = np.array(weights)
    free = np.zeros((max(n, 1), 3))  # of open sequences
    name = np.zeros(max(n, 1), dtype=np.int64)
    opened = 0
    sequence, offset = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    used: list[int] = []
    order = np.lexsort((np.arange(n), -lengths))
    least = int(lengths.min()) if n else 0
    for i in order.tolist():
        length = int(lengths[i])
        need = np.array([length, 1, length * length], dtype=np.float64)
        left = free[:opened]
        fits = np.flatnonzero((left[:, 0] >= need[0]) & (left[:, 1] >= 1) & (left[:, 2] >= need[2]))
        if len(fits):
            there = left[fits] / scale
            if by == "norm":
                place = fits[np.argmin((((there - need / scale) ** 2) * w).sum(axis=1))]
            else:
                place = fits[np.argmax((there * (need / scale) * w).sum(axis=1))]
        else:
            place = opened
            free[place] = scale
            name[place] = len(used)
            used.append(0)
            opened += 1
        own = int(name[place])
        sequence[i], offset[i] = own, used[own]
        used[own] += length
        free[place] -= need
        if free[place, 0] < least or free[place, 1] < 1 or free[place, 2] < least * least:
            opened -= 1  # nothing fits any more: the last open sequence takes the place
            free[place], name[place] = free[opened], name[opened]
    return sequence, offset


def pieces(docs: DataFrame, vocabulary: str | None = None, tokens: int = TOKENS, end_id: int = END_ID) -> DataFrame:
    """Ids of whole texts (null: empty) and ``end_id``, in pieces of ``tokens`` ids; the last one may be shorter.

    doc_id, piece, start (of the piece in its document), length, ids_crc32. No shuffle.
    """
    path = vocabulary or default_vocabulary()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in slices(batches, "text"):
            ids, counts = own.encode(batch.column("text"))
            ends = offsets(counts)
            whole = np.insert(ids, ends[1:], end_id).astype("<u4")
            counts = counts + 1
            starts = offsets(counts)[:-1]
            n = -(-counts // tokens)
            row = np.repeat(np.arange(len(counts)), n)
            piece = np.arange(len(row)) - np.repeat(offsets(n)[:-1], n)
            start = piece * tokens
            length = np.minimum(tokens, counts[row] - start)
            at = starts[row] + start
            view = memoryview(whole).cast("B")
            crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(at.tolist(), (at + length).tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, PIECES)


def pack_pieces(cut: DataFrame, tokens: int = TOKENS, documents: int | None = None, cost: int | None = None, by: str = "norm", group: int = GROUP) -> DataFrame:
    """``cut`` (with ``length``) with ``sequence_id`` and ``offset``. It is read twice and should be stored.

    Rows are dealt by turns, so copies do not meet in one group; a group has ``group`` rows at most, give or take a few.
    """
    groups = max(1, -(-cut.count() // group))
    fields = cut.schema.simpleString()[len("struct<") : -1].replace(":", " ")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held) if (held := [b for b in batches if b.num_rows]) else None
        if table is None:
            return
        table = table.combine_chunks()
        sequence, offset = pack(table.column("length").to_numpy(), tokens, documents, cost, by)
        base = TaskContext.get().partitionId() << 32
        table = table.append_column("sequence_id", pa.array(sequence + base)).append_column("offset", pa.array(offset))
        yield from table.to_batches()

    return cut.repartition(groups).mapInArrow(fill, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary: str | None = None, tokens: int = TOKENS, documents: int | None = None, cost: int | None = None, by: str = "norm") -> DataFrame:
    """Place of every piece of every document. Documents without text have one piece, the end id; null and repeated
    doc_ids are documents like others; an empty table gives no rows; other columns don't matter."""
    return pack_pieces(store(pieces(docs, vocabulary, tokens), "pieces"), tokens, documents, cost, by)
