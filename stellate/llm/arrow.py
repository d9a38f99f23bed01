"""Helpers for the work inside tasks: Arrow batches cut to a bounded number of bytes, and ragged arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose ``column`` (text or binary) holds at most ``max_bytes``, or one longer row."""
    for batch in batches:
        size = sizes(batch.column(column))
        ends = np.cumsum(size)
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, done + max_bytes, side="right")))
            yield batch.slice(at, upto - at)
            at = upto


def sizes(column: pa.Array) -> np.ndarray:
    """Bytes of each cell; 0 for null."""
    return np.array([0 if v is None else v for v in _lengths(column)], dtype=np.int64)


def _lengths(column: pa.Array) -> list[int | None]:
    import pyarrow.compute as pc

    return pc.binary_length(column.cast(binary_like(column))).to_pylist()


def binary_like(column: pa.Array) -> pa.DataType:
    return pa.large_binary() if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else pa.binary()


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """Cells as UTF-8 bytes without decoding them."""
    return column.cast(binary_like(column)).to_pylist()


def ragged_take(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``starts[i] .. starts[i] + lengths[i] - 1`` of every i, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    out = np.ones(total, dtype=np.int64)
    some = lengths > 0
    first, count = starts[some].astype(np.int64), lengths[some].astype(np.int64)
    out[0] = first[0]
    at = np.cumsum(count)[:-1]
    out[at] = first[1:] - first[:-1] - count[:-1] + 1
    return np.cumsum(out)


def offsets(lengths: np.ndarray) -> np.ndarray:
    """Start of each of some pieces that lie one after the other, and the end of the last."""
    out = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=out[1:])
    return out
