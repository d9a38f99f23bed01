"""Token ids of whole texts through the ``tokenizers`` library.

Texts go to the library whole, unless the vocabulary's file has the normaliser and the pre-tokenizer of ``PIECEWISE``, as the
default one does. That pre-tokenizer never lets a token cross white space, nor a border between an ASCII letter or digit and an
ASCII punctuation character other than the apostrophe. So a text's ids are the ids of the pieces between such borders, one
after the other. A worker keeps the ids of the pieces that it has seen, up to a bound, and asks the library for new ones
only. Texts for which this does not hold as plainly go to the library whole: those that hold a special token's text, a
control character used as a mark below, or a very long piece.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa

from .arrow import as_bytes, offsets, ragged_take
from .words import LONGEST, Table, buffer_of, hashes, runs

VOCABULARY = "word_bpe_49k.json"
#: Pieces that a worker keeps at most; past it, it starts with an empty table again.
KEPT = 1_000_000
#: A control character as a word of its own marks where one piece's ids end when many are encoded in one call.
MARK = b"\x01"
JOINED = 500

SPACE, WORD, PUNCTUATION, OTHER = 0, 1, 2, 3
KIND = np.full(256, OTHER, dtype=np.uint8)
KIND[[9, 10, 11, 12, 13, 32]] = SPACE
KIND[[c for c in range(33, 127) if chr(c) != "'"]] = PUNCTUATION
KIND[[c for c in range(128) if chr(c).isalnum()]] = WORD
IS_UPPER = np.zeros(256, dtype=bool)
IS_UPPER[65:91] = True

# The parts of a vocabulary's file for which texts may be cut into pieces.
PIECEWISE = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
    "truncation": None,
    "padding": None,
}

_ENCODERS: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    """The worker's encoder for a vocabulary file; it lives as long as the worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def default_vocabulary() -> str:
    import public_tokenizers

    return str(public_tokenizers.path(VOCABULARY))


class Encoder:
    def __init__(self, path: str, kept: int = KEPT):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [t.content.encode() for t in added]
        mark = self._whole(MARK)
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        plain = not any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in added)
        self.piecewise = plain and len(mark) == 1 and all(settings.get(k) == v for k, v in PIECEWISE.items())
        self.mark = mark[0] if mark else None
        self.kept = kept
        self._clear()

    def _whole(self, text: bytes) -> list[int]:
        return self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids

    def _clear(self) -> None:
        self.table = Table()
        self.ids = np.zeros(1 << 18, dtype=np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32)
        self.start = np.zeros(1 << 16, dtype=np.int64)
        self.length = np.zeros(1 << 16, dtype=np.int32)
        self.used = 0

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids (uint32) of all texts one after the other, and how many each text has. A null has none."""
        if not self.piecewise:
            return self._all_whole(texts)
        if self.table.size > self.kept:
            self._clear()
        data, at = buffer_of(texts)
        data, start, end = _pieces(data)
        odd = self._odd(data, at, start, end)
        if odd:
            data = data.copy()
            whole = {i: self._whole(texts[i].as_py() if isinstance(texts[i].as_py(), bytes) else texts[i].as_py().encode()) for i in odd}
            for i in odd:
                data[at[i] : at[i + 1]] = 32
            data, start, end = _pieces(data)
        rows, new = self.table.number(hashes(data, start, end))
        if len(new):
            held = data.tobytes()
            self._add([held[a:b] for a, b in zip(start[new].tolist(), end[new].tolist())])
        length = self.length[rows].astype(np.int64)
        ids = self.ids[ragged_take(self.start[rows], length)].astype(np.uint32)
        counts = np.diff(offsets(length)[np.searchsorted(start, at)])
        return (ids, counts) if not odd else _with(ids, counts, whole)

    def _all_whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        said = [b"" if t is None else t for t in as_bytes(texts)]
        found = [e.ids for e in self.tokenizer.encode_batch([t.decode("utf-8", "replace") for t in said], add_special_tokens=False)]
        counts = np.array([len(f) if t is not None else 0 for f, t in zip(found, as_bytes(texts))], dtype=np.int64)
        ids = [np.array(f, dtype=np.uint32) for f, n in zip(found, counts) if n]
        return np.concatenate(ids) if ids else np.zeros(0, dtype=np.uint32), counts

    def _odd(self, data: np.ndarray, at: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[int]:
        """Texts that go to the library whole."""
        held = data.tobytes()
        found = np.flatnonzero(end - start > LONGEST)
        places = start[found].tolist()
        for text in [MARK, *self.special]:
            text = text.lower()  # as the bytes are
            here = held.find(text)
            while here >= 0:
                places.append(here)
                here = held.find(text, here + 1)
        return sorted(set((np.searchsorted(at, np.array(places, dtype=np.int64), side="right") - 1).tolist()))

    def _add(self, pieces: list[bytes]) -> None:
        joint = b" " + MARK + b" "
        texts = [joint.join(pieces[i : i + JOINED]) + joint for i in range(0, len(pieces), JOINED)]
        found = self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
        flat = np.concatenate([np.array(e.ids, dtype=np.uint32) for e in found])
        length = np.diff(np.flatnonzero(flat == self.mark), prepend=-1) - 1
        flat = flat[flat != self.mark]
        to = self.table.size
        at = to - len(pieces)
        self.ids = _room(self.ids, self.used + len(flat))
        self.start, self.length = _room(self.start, to), _room(self.length, to)
        self.ids[self.used : self.used + len(flat)] = flat
        self.start[at:to] = self.used + offsets(length)[:-1]
        self.length[at:to] = length
        self.used += len(flat)


def _pieces(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with A-Z lower-cased where no combining character can follow, and where each piece starts and ends."""
    ascii_next = np.append(data[1:] < 128, True)
    data = np.where(IS_UPPER[data] & ascii_next, data | 32, data)
    kind = KIND[data]
    cut = np.zeros(len(data), dtype=bool)
    cut[1:] = (kind[1:] ^ kind[:-1]) == (WORD ^ PUNCTUATION)
    start, end = runs(kind != SPACE, cut & (kind != SPACE) & (kind != OTHER))
    return data, start, end


def _with(ids: np.ndarray, counts: np.ndarray, whole: dict[int, list[int]]) -> tuple[np.ndarray, np.ndarray]:
    ends = offsets(counts)
    parts, counts = [], counts.copy()
    for i in range(len(counts)):
        parts.append(np.array(whole[i], dtype=np.uint32) if i in whole else ids[ends[i] : ends[i + 1]])
        counts[i] = len(parts[-1])
    return np.concatenate(parts), counts


def _room(array: np.ndarray, need: int) -> np.ndarray:
    if need <= len(array):
        return array
    return np.concatenate([array, np.zeros(max(need - len(array), len(array)), dtype=array.dtype)])
