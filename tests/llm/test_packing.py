"""Every piece once, no capacity exceeded, few sequences."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from stellate.llm import queries
from stellate.llm.packing import pack, pack_documents
from stellate.llm.tokens import default_vocabulary

from . import cases


@pytest.mark.parametrize("by", ["norm", "dot"])
@pytest.mark.parametrize("documents, cost", [(None, None), (3, None), (None, 300_000), (4, 200_000)])
def test_no_capacity_is_exceeded(by, documents, cost):
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 400, 700)
    sequence, offset = pack(lengths, 1000, documents, cost, by)
    total = np.bincount(sequence, lengths)
    assert total.max() <= 1000
    assert np.bincount(sequence).max() <= (documents or 1000)
    assert np.bincount(sequence, lengths.astype(float) ** 2).max() <= (cost or 1000**2)
    for s in range(sequence.max() + 1):
        own = np.flatnonzero(sequence == s)
        own = own[np.argsort(offset[own])]
        assert (offset[own] == np.append(0, np.cumsum(lengths[own])[:-1])).all()
    least = max(lengths.sum() / 1000, len(lengths) / (documents or 1000), (lengths.astype(float) ** 2).sum() / (cost or 1000**2))
    assert sequence.max() + 1 <= 1.25 * least + 2


def test_tokens_alone_are_packed_closely():
    lengths = np.random.default_rng(3).integers(1, 1500, 3000)
    sequence, _ = pack(lengths, 2048)
    assert sequence.max() + 1 <= 1.02 * lengths.sum() / 2048 + 1


def _check(out, rows):
    library = Tokenizer.from_file(default_vocabulary())
    want = Counter()
    for doc, text in rows:
        ids = (library.encode(text, add_special_tokens=False).ids if text else []) + [0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at : at + 2048], dtype="<u4")
            want[doc, k, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == want
    places = defaultdict(list)
    for r in out:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    return len(places)


def test_query_over_all_documents(spark):
    rows = [tuple(r) for r in cases.documents(spark).select("doc_id", "text").collect()]
    out = cases.collect(queries.QUERIES["op9_vector_best_fit"](spark, cases.SF))
    assert _check(out, rows) <= 1.03 * sum(r["length"] for r in out) / 2048 + 1


def test_odd_and_empty_tables(spark):
    _check(cases.collect(pack_documents(cases.odd_documents(spark))), [(r[0], r[1]) for r in cases.rows()])
    assert pack_documents(cases.no_documents(spark)).count() == 0


def test_groups_are_packed_apart(spark):
    from stellate.llm.packing import pack_pieces, pieces

    cut = pieces(cases.documents(spark)).persist()
    out = cases.collect(pack_pieces(cut, group=100))
    _check(out, [tuple(r) for r in cases.documents(spark).select("doc_id", "text").collect()])
    cut.unpersist()
