"""Token ids in files compressed by Re-Pair grammars.

A shard is a run of documents in ascending order of their ids. In each round all pairs of neighbouring symbols in it are
counted, the most frequent ones become rules (new symbols), and their occurrences are replaced from left to right. No rule
crosses a document's end. A file holds the rules, the length of each rule's expansion, the number of symbols of each
document, and the symbols: a single document, or a position in it, is decoded without touching the others.

Files are written under names of their own attempt and get their final names from the written list of files (the manifest),
so a lost executor leaves at most files that no list names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import new_dir
from . import files
from .arrow import CHUNK_BYTES, offsets, slices
from .order import running_start, sorted_by
from .tokens import default_vocabulary, encoder

END_ID = 1
SHARD_TOKENS = 4 << 20
#: By the bytes of a symbol.
MAGIC = {2: b"RPIDS001", 4: b"RPIDS002"}
MANIFEST = "part int, number int, temporary string, final string, documents long, tokens long, bytes long"
_HASH = np.uint32(0x9E3779B1)
_WIDE_HASH = np.uint64(0x9E3779B97F4A7C15)
#: Rules that must fit beside the ids into 16 bits, and new rules of one round at most.
ROOM, MOST_A_ROUND = 4096, 1 << 16


# ---- grammar -----------------------------------------------------------------------------------------------------


def compress(ids: np.ndarray, counts: np.ndarray, base: int, rounds: int = 6, least: int = 8) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all documents, symbols of each document, and rules as pairs of symbols.

    Ids are below ``base``; rule k is the symbol ``base + k``. Symbols have 16 bits, which bounds the rules; if fewer than
    ``ROOM`` rules were left by the ids, they have 32 bits. A pair becomes a rule if it occurs ``least`` times in the shard.
    """
    if len(ids) and int(ids.max()) >= base:
        raise ValueError(f"an id is {int(ids.max())}, but ids are to be below {base}")
    bits = 16 if base <= (1 << 16) - ROOM else 32
    kind, symbol = (np.uint32, np.uint16) if bits == 16 else (np.uint64, np.uint32)
    limit = (1 << 16) - base if bits == 16 else (1 << 32) - base
    mask = kind((1 << bits) - 1)
    place = (lambda k: (k * _HASH) >> np.uint32(12)) if bits == 16 else (lambda k: (k * _WIDE_HASH) >> np.uint64(44))
    symbols, ends = ids.astype(kind), np.cumsum(counts) - 1
    rules = np.zeros((0, 2), dtype=kind)
    table_key, table_rule = np.zeros(1 << 20, dtype=kind), np.full(1 << 20, -1, dtype=np.int32)
    for turn in range(rounds):
        room = limit - len(rules)
        if len(symbols) < 2 or room <= 0:
            break
        keys = (symbols[:-1] << kind(bits)) | symbols[1:]
        inside = np.ones(len(keys), dtype=bool)
        inside[ends[(ends >= 0) & (ends < len(keys))]] = False
        ordered = np.sort(keys[inside])
        first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.zeros(0, dtype=np.int64)
        often = np.diff(np.append(first, len(ordered)))
        good = np.flatnonzero(often >= least)
        if not len(good):
            break
        quota = min(room if turn == rounds - 1 else max(1, room // 2), MOST_A_ROUND)
        if len(good) > quota:
            good = good[np.argsort(-often[good], kind="stable")[:quota]]
        chosen = ordered[first[good]]
        slot = place(chosen)
        _, alone = np.unique(slot, return_index=True)  # of pairs that share a place the first one, the others may come later
        chosen, slot = chosen[alone], slot[alone]
        table_key[slot] = chosen
        table_rule[slot] = np.arange(len(chosen)) + len(rules)
        at = place(keys)
        rule = np.where(table_key[at] == keys, table_rule[at], -1)
        rule[~inside] = -1
        table_rule[slot] = -1
        hit = rule >= 0
        run = np.flatnonzero(hit & ~np.append(False, hit[:-1]))  # overlapping occurrences: every second one of a run
        since = np.arange(len(hit)) - np.repeat(np.append(0, run), np.diff(np.append(np.append(0, run), len(hit))))
        taken = np.flatnonzero(hit & (since % 2 == 0))
        if not len(taken):
            break
        keep = np.ones(len(symbols), dtype=bool)
        keep[taken + 1] = False
        symbols[taken] = rule[taken].astype(kind) + kind(base)
        ends = np.cumsum(keep)[ends] - 1 if len(ends) else ends
        symbols = symbols[keep]
        rules = np.concatenate([rules, np.stack([chosen >> kind(bits), chosen & mask], axis=1)])
    ends = np.where(counts > 0, ends, -1)
    own = np.diff(np.maximum.accumulate(ends), prepend=-1)
    return symbols.astype(symbol), own.astype(np.int64), rules.astype(symbol)


def expansion_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """Ids that each rule stands for. Rules name earlier symbols only."""
    out = [0] * len(rules)
    for k, (a, b) in enumerate(rules.tolist()):
        out[k] = (1 if a < base else out[a - base]) + (1 if b < base else out[b - base])
    return np.array(out, dtype=np.uint32)


def expand(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """Ids of a run of symbols: all rules in it are replaced by their pairs, until none is left."""
    out = symbols.astype(np.uint32)
    while len(rule := np.flatnonzero(out >= base)):
        width = np.ones(len(out), dtype=np.int64)
        width[rule] = 2
        wide = np.repeat(out, width)
        first = offsets(width)[:-1][rule]
        pair = rules[out[rule] - base]
        wide[first], wide[first + 1] = pair[:, 0], pair[:, 1]
        out = wide
    return out


# ---- file format -------------------------------------------------------------------------------------------------


class Shard:
    """One file's content; ``document(k)`` and ``tokens(k, start, stop)`` decode no other document."""

    def __init__(self, base: int, doc_ids: list[int | None], counts: np.ndarray, rules: np.ndarray, lengths: np.ndarray, symbols: np.ndarray):
        self.base, self.doc_ids, self.counts = base, doc_ids, counts
        self.rules, self.lengths, self.symbols = rules, lengths, symbols
        self.at = offsets(counts)

    def to_bytes(self) -> bytes:
        known = np.array([d is not None for d in self.doc_ids], dtype=np.uint8)
        numbers = np.array([d or 0 for d in self.doc_ids], dtype="<i8")
        head = np.array([self.base, len(self.doc_ids), len(self.rules), len(self.symbols)], dtype="<i8")
        size = self.symbols.dtype.itemsize
        parts = [head, numbers, known, self.counts.astype("<u4"), self.rules.astype(f"<u{size}"), self.lengths.astype("<u4"), self.symbols.astype(f"<u{size}")]
        body = b"".join(p.tobytes() for p in parts)
        return MAGIC[size] + zlib.crc32(body).to_bytes(4, "little") + body

    @classmethod
    def from_bytes(cls, data: bytes) -> "Shard":
        size = {v: k for k, v in MAGIC.items()}.get(bytes(data[:8]))
        if size is None or zlib.crc32(memoryview(data)[12:]) != int.from_bytes(data[8:12], "little"):
            raise ValueError("not a whole Re-Pair file")
        at = 12

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, dtype=kind, count=n, offset=at)
            at += out.nbytes
            return out

        base, documents, rules, symbols = take("<i8", 4).tolist()
        numbers, known = take("<i8", documents), take("u1", documents)
        counts = take("<u4", documents).astype(np.int64)
        pairs, lengths = take(f"<u{size}", 2 * rules).reshape(-1, 2), take("<u4", rules)
        return cls(base, [d if k else None for d, k in zip(numbers.tolist(), known.tolist())], counts, pairs, lengths, take(f"<u{size}", symbols))

    def document(self, k: int) -> np.ndarray:
        return expand(self.symbols[self.at[k] : self.at[k + 1]], self.rules, self.base)

    def widths(self, symbols: np.ndarray) -> np.ndarray:
        out = np.ones(len(symbols), dtype=np.int64)
        rule = symbols >= self.base
        out[rule] = self.lengths[symbols[rule].astype(np.int64) - self.base]
        return out

    def tokens(self, k: int, start: int, stop: int) -> np.ndarray:
        """Ids ``start:stop`` of document k: only the symbols that cover them are expanded."""
        own = self.symbols[self.at[k] : self.at[k + 1]]
        ends = np.cumsum(self.widths(own))
        a, b = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop, side="left") + 1
        before = int(ends[a - 1]) if a else 0
        return expand(own[a:b], self.rules, self.base)[start - before : stop - before]

    def all_tokens(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents, and how many each has."""
        width = offsets(self.widths(self.symbols))
        return expand(self.symbols, self.rules, self.base), np.diff(width[self.at])


# ---- write and read ----------------------------------------------------------------------------------------------


def write(docs: DataFrame, folder: str, vocabulary: str | None = None, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write the ids of all whole texts (null: empty), each with ``end_id`` after it, in ascending order of doc_id (null
    first, repeated ids in the order of their texts). Returns the manifest as read back, with each file's first token."""
    path = vocabulary or default_vocabulary()
    session = docs.sparkSession
    folder = files.qualified(session, folder)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, number = encoder(path), TaskContext.get().partitionId(), 0
        base = own.tokenizer.get_vocab_size(with_added_tokens=True)
        store, place = files.open_fs(folder)
        store.create_dir(place, recursive=True)
        held: list[tuple[list[int | None], np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            nonlocal number
            ids, counts = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            symbols, own_symbols, rules = compress(ids, counts, base)
            shard = Shard(base, [d for h in held for d in h[0]], own_symbols, rules, expansion_lengths(rules, base), symbols)
            data = shard.to_bytes()
            final = f"ids-{part:06d}-{number:05d}.rpids"
            temporary = files.attempt_name(final)
            with store.open_output_stream(files.join(place, temporary), compression=None) as out:
                out.write(data)
            row = [part, number, temporary, final, len(counts), int(counts.sum()), len(data)]
            number += 1
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()])], names)

        for batch in slices(batches, "text", min(CHUNK_BYTES, 2 * shard_tokens)):
            ids, counts = own.encode(batch.column("text"))
            held.append((batch.column("doc_id").to_pylist(), np.insert(ids, np.cumsum(counts), end_id), counts + 1))
            if sum(len(h[1]) for h in held) >= shard_tokens:
                yield flush()
        if held:
            yield flush()

    names = [f.split()[0] for f in MANIFEST.split(", ")]
    ordered = sorted_by(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), "doc_id", F.xxhash64("text"))
    listed = files.join(folder, "_list")
    ordered.mapInArrow(put, MANIFEST).write.parquet(listed)
    return files.publish(session.read.schema(MANIFEST).parquet(listed), folder)


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    folder = files.qualified(manifest.sparkSession, folder)
    placed = running_start(manifest, "part", "number", "tokens", "first_token").select("final", "first_token")

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = files.open_fs(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_stream(files.join(place, row["final"]), compression=None) as source:
                    shard = Shard.from_bytes(source.read())
                ids, counts = shard.all_tokens()
                ends = offsets(counts)
                view = memoryview(ids.astype("<u4")).cast("B")
                crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.doc_ids, pa.int64()), pa.array(ends[:-1] + row["first_token"]), pa.array(counts), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return files.readers(placed).mapInArrow(get, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, folder: str | None = None, vocabulary: str | None = None) -> DataFrame:
    """Write all documents' ids and read the files back. An empty table writes no file and gives no row."""
    folder = folder or new_dir(docs.sparkSession, "token-ids")
    return read(write(docs, folder, vocabulary), folder)
