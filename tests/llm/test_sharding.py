"""The permutation by itself, the law on shards, and odd tables."""

import zlib
from collections import Counter

import numpy as np
import pytest

from stellate.llm import queries
from stellate.llm.sharding import permute, shard_documents

from . import cases


@pytest.mark.parametrize("n", [1, 2, 3, 24, 1000, 4097])
def test_permutation_and_its_inverse(n):
    numbers = np.arange(n)
    there = permute(numbers, n, seed=5)
    assert sorted(there.tolist()) == numbers.tolist()
    assert (permute(there, n, 5, backwards=True) == numbers).all()
    assert n < 100 or (there != permute(numbers, n, 6)).mean() > 0.9


def _check(out, rows, shards):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows
    )
    by = Counter(r["shard"] for r in out)
    counts = [by[s] for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(out)
    for s in range(shards):
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(by[s]))
    assert {r["law"] for r in out} <= {"rows"} and all(r["grown_shard"] is None for r in out)


def test_query_over_all_documents(spark):
    docs = cases.documents(spark)
    out = cases.collect(queries.QUERIES["op3_feistel_shards"](spark, cases.SF))
    _check(out, [tuple(r) for r in docs.select("doc_id", "text").collect()], 24)
    n = len(out)
    place = permute(np.array([r["row_number"] for r in out]), n, 2024)
    assert all(p % 24 == r["shard"] and p // 24 == r["slot"] for p, r in zip(place.tolist(), out))
    assert [r["doc_id"] for r in sorted(out, key=lambda r: r["row_number"])] == sorted(r["doc_id"] for r in out)


def test_same_places_each_time(spark):
    docs = cases.documents(spark)
    first = {r["doc_id"]: (r["shard"], r["slot"]) for r in cases.collect(shard_documents(docs))}
    again = {r["doc_id"]: (r["shard"], r["slot"]) for r in cases.collect(shard_documents(docs.repartition(13)))}
    assert first == again


def test_odd_and_empty_tables(spark):
    odd = cases.odd_documents(spark)
    _check(cases.collect(shard_documents(odd, 5)), [(r[0], r[1]) for r in cases.rows()], 5)
    assert shard_documents(cases.no_documents(spark)).count() == 0
