"""Words of many texts at once, found and numbered with numpy on the texts' own bytes."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

from .arrow import binary_like

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_BLOCK = 1 << 20
#: Longer words get a hash of another kind.
LONGEST = 1000


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All cells' bytes with a space after each (a copy), and where each cell starts, and the end. Nulls are empty."""
    column = column.cast(binary_like(column))
    wide = pa.types.is_large_binary(column.type)
    at = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    length = np.diff(at)
    if column.null_count:
        length = np.where(column.is_null().to_numpy(zero_copy_only=False), 0, length)
    data = column.buffers()[2]
    source = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    starts = np.zeros(len(column) + 1, dtype=np.int64)
    np.cumsum(length + 1, out=starts[1:])
    out = np.full(int(starts[-1]), 32, dtype=np.uint8)
    if not column.null_count and len(column):
        keep = np.ones(len(out), dtype=bool)
        keep[starts[1:] - 1] = False
        out[keep] = source[at[0] : at[-1]]
    else:
        for i in np.flatnonzero(length):
            out[starts[i] : starts[i] + length[i]] = source[at[i] : at[i] + length[i]]
    return out, starts


def runs(inside: np.ndarray, cut: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of true bytes; ``cut`` marks bytes that start a new run within one."""
    before = np.zeros(len(inside), dtype=bool)
    before[1:] = inside[:-1]
    first = inside & ~before
    if cut is not None:
        first |= cut & inside
    start = np.flatnonzero(first)
    last = np.flatnonzero(inside & ~np.append(inside[1:] & ~first[1:], False))
    return start, last + 1


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS:
        _POWERS["up"] = np.cumprod(np.full(_BLOCK + LONGEST + 1, _BASE, dtype=np.uint64))
        _POWERS["down"] = np.cumprod(np.full(_BLOCK + LONGEST + 1, np.uint64(pow(int(_BASE), -1, 1 << 64)), dtype=np.uint64))
    return _POWERS["up"][:n], _POWERS["down"][:n]


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word ``data[start:end]``. Words lie in ascending order."""
    long = np.flatnonzero(end - start > LONGEST)
    if len(long):
        end = end.copy()
        other = [hashlib.blake2b(data[a:b].tobytes(), digest_size=8).digest() for a, b in zip(start[long].tolist(), end[long].tolist())]
        end[long] = start[long]
    out = np.zeros(len(start), dtype=np.uint64)
    at = 0
    while at < len(start):
        upto = int(np.searchsorted(start, start[at] + _BLOCK, side="left"))
        low, high = int(start[at]), int(end[upto - 1])
        up, down = _powers(high - low)
        total = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * up, out=total[1:])
        a, b = start[at:upto] - low, end[at:upto] - low
        out[at:upto] = (total[b] - total[a]) * down[a]
        at = upto
    if len(long):
        out[long] = np.frombuffer(b"".join(other), dtype=np.uint64)
    out ^= out >> np.uint64(29)
    out *= _MIX
    out ^= out >> np.uint64(32)
    out[out == 0] = 1  # 0 marks a free place in a table
    return out


class Table:
    """Numbers 0, 1, 2, ... for 64-bit keys in the order of their arrival; open addressing over numpy arrays."""

    def __init__(self, bits: int = 16):
        self.bits, self.size = bits, 0
        self.keys = np.zeros(1 << bits, dtype=np.uint64)
        self.rows = np.zeros(1 << bits, dtype=np.int32)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, or -1."""
        mask = np.int64((1 << self.bits) - 1)
        slot = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        there = self.keys[slot]
        out = np.where(there == keys, self.rows[slot], -1).astype(np.int64)
        open_ = np.flatnonzero((there != keys) & (there != 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & mask
            there = self.keys[slot[open_]]
            hit = there == keys[open_]
            out[open_[hit]] = self.rows[slot[open_[hit]]]
            open_ = open_[~hit & (there != 0)]
        return out

    def _put(self, keys: np.ndarray, rows: np.ndarray) -> None:
        mask = np.int64((1 << self.bits) - 1)
        slot = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        left = np.arange(len(keys))
        while len(left):
            free = self.keys[slot[left]] == 0
            want = left[free]
            self.rows[slot[want]] = rows[want]  # of several keys for a place the last one stays
            won = self.rows[slot[want]] == rows[want]
            self.keys[slot[want[won]]] = keys[want[won]]
            left = np.concatenate([want[~won], left[~free]])
            slot[left] = (slot[left] + 1) & mask

    @classmethod
    def of(cls, keys: np.ndarray) -> "Table":
        """Rows 0, 1, ... for some distinct keys, in their order."""
        out = cls(max(8, int(2 * len(keys) + 1).bit_length()))
        out._put(keys, np.arange(len(keys), dtype=np.int32))
        out.size = len(keys)
        return out

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, or -1."""
        return self._find(keys)

    def number(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row of every key, and for each key not seen before, in the order of their new rows, one place in ``keys``."""
        rows = self._find(keys)
        missing = np.flatnonzero(rows < 0)
        if not len(missing):
            return rows, missing
        new, first, back = np.unique(keys[missing], return_index=True, return_inverse=True)
        rows[missing] = self.size + back
        if 2 * (self.size + len(new)) > len(self.keys):
            used = np.flatnonzero(self.keys)
            old_keys, old_rows = self.keys[used], self.rows[used]
            while 2 * (self.size + len(new)) > 1 << self.bits:
                self.bits += 1
            self.keys = np.zeros(1 << self.bits, dtype=np.uint64)
            self.rows = np.zeros(1 << self.bits, dtype=np.int32)
            self._put(old_keys, old_rows)
        self._put(new, np.arange(self.size, self.size + len(new), dtype=np.int32))
        self.size += len(new)
        return rows, missing[first]
