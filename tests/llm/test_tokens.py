"""Ids against the library itself, text by text."""

import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from stellate.llm.tokens import Encoder, default_vocabulary
from stellate.llm.words import Table, hashes, runs

from . import cases

CHARACTERS = [chr(i) for i in range(256)] + list("—́̌KKİΣς　漢字한한\U0001f600J") + ["'s", "'re", "'ll", "J̌", "!'s", "..."]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(default_vocabulary())


def texts():
    rng = random.Random(5)
    return ["".join(rng.choice(CHARACTERS) for _ in range(rng.randint(0, 30))) for _ in range(1500)] + cases.TEXTS


@pytest.mark.parametrize("step", [1, 7, 2000])
def test_ids_are_the_library_s(library, step):
    own, all_texts = Encoder(default_vocabulary(), kept=500), texts()
    for at in range(0, len(all_texts), step):
        part = all_texts[at : at + step]
        ids, counts = own.encode(pa.array(part, pa.string()))
        ends = np.append(0, np.cumsum(counts))
        for k, text in enumerate(part):
            want = [] if text is None else library.encode(text, add_special_tokens=False).ids
            assert ids[ends[k] : ends[k + 1]].tolist() == want, text


def test_table_numbers_keys_once():
    rng = np.random.default_rng(1)
    table, seen = Table(4), {}
    for _ in range(20):
        keys = rng.integers(1, 3000, 500).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        rows, new = table.number(keys)
        for key, row in zip(keys.tolist(), rows.tolist()):
            assert seen.setdefault(key, row) == row
        assert len(new) == len(set(keys[new].tolist()))
    assert sorted(seen.values()) == list(range(len(seen))) and table.size == len(seen)


def test_hash_depends_on_the_word_alone():
    data = np.frombuffer(b"one two one " + b"z" * 3000 + b" " + b"z" * 3000 + b" two", dtype=np.uint8)
    start, end = runs(data != 32)
    h = hashes(data, start, end).tolist()
    assert h[0] == h[2] and h[1] == h[5] and h[3] == h[4] and len(set(h)) == 3


@pytest.fixture(scope="module")
def cased(tmp_path_factory):
    """A vocabulary of another kind: letter case counts, and words are cut at hyphens."""
    from tokenizers import models, pre_tokenizers

    words = ["[UNK]", "The", "the", "Fox", "fox", "quick", "Hello", ",", "world", "-", "."]
    own = Tokenizer(models.WordLevel({w: i for i, w in enumerate(words)}, unk_token="[UNK]"))
    own.pre_tokenizer = pre_tokenizers.Whitespace()
    path = str(tmp_path_factory.mktemp("vocabulary") / "cased.json")
    own.save(path)
    return path


@pytest.mark.parametrize("name", ["cased", "byte_bpe_50k.json"])
def test_other_vocabularies(cased, name):
    """Files with another normaliser or pre-tokenizer get whole texts."""
    import public_tokenizers

    path = cased if name == "cased" else str(public_tokenizers.path(name))
    own, library, all_texts = Encoder(path), Tokenizer.from_file(path), texts() + ["The quick Fox", "Hello, world", "the  fox-The\n"]
    assert not own.piecewise and Encoder(default_vocabulary()).piecewise
    ids, counts = own.encode(pa.array(all_texts, pa.string()))
    ends = np.append(0, np.cumsum(counts))
    for k, text in enumerate(all_texts):
        want = [] if text is None else library.encode(text, add_special_tokens=False).ids
        assert ids[ends[k] : ends[k + 1]].tolist() == want, text
    assert [len(x) for x in own.encode(pa.array([None, None], pa.string()))] == [0, 2]
