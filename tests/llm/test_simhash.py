"""Fingerprints and groups against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stellate.llm import queries, simhash
from stellate.llm.components import connected

from . import cases

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _print(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    values = np.array([xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles], dtype=np.uint64)
    return sum(1 << b for b in range(64) if 2 * int(((values >> np.uint64(b)) & np.uint64(1)).sum()) > len(values))


def _roots(links, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def _groups(values, bits=3):
    links = [(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= bits]
    return _roots(links, values)


def _check(out, rows):
    prints = [_print(t) for _, t in rows]
    roots = _groups(sorted(set(prints)))
    least = {}
    for (doc, _), p in zip(rows, prints):
        least.setdefault(roots[p], []).append(doc)
    least = {r: min((d for d in own if d is not None), default=None) for r, own in least.items()}
    want = [(doc, format(p, "016x"), least[roots[p]]) for (doc, _), p in zip(rows, prints)]
    got = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in out]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_query_over_all_documents(spark):
    rows = [tuple(r) for r in cases.documents(spark).select("doc_id", "text").collect()]
    _check(cases.collect(queries.QUERIES["op6_simhash_byte_index"](spark, cases.SF)), rows)


def test_odd_and_empty_tables(spark):
    odd = cases.odd_documents(spark)
    _check(cases.collect(simhash.near_duplicates(odd)), [(r[0], r[1]) for r in cases.rows()])
    assert simhash.near_duplicates(cases.no_documents(spark)).count() == 0
    kept = simhash.deduplicate(odd)
    assert kept.columns == odd.columns and kept.schema == odd.schema
    groups = _groups(sorted({_print(r[1]) for r in cases.rows()}))
    assert kept.count() == len(set(groups.values()))
    assert simhash.deduplicate(cases.no_documents(spark)).count() == 0


def _cloud(n, seed):
    """Fingerprints around a few centres, so that lists are long and chains of links matter."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(4)]
    out = set()
    while len(out) < n:
        value = rng.choice(centres)
        for _ in range(rng.randint(0, 5)):
            value ^= 1 << rng.randrange(64)
        out.add(value)
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 8])
def test_links_connect_what_is_near(spark, block):
    values = _cloud(400, block)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "_fp long")
    links = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.link_forest(frame, block=block).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in links)
    assert _roots(links, values) == _groups(values)


def test_every_near_pair_meets_in_a_list():
    rng = random.Random(9)
    masks = [m % (1 << 64) for m in simhash.masks()]
    for _ in range(2000):
        a = rng.getrandbits(64)
        b = a
        for _ in range(3):
            b ^= 1 << rng.randrange(64)
        assert any((a ^ b) & m == 0 for m in masks)
        (shared,) = simhash.shared_bytes(np.array([a ^ b], dtype=np.uint64))
        assert shared == sum((a ^ b) >> (8 * k) & 255 == 0 for k in range(8)) >= 5


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(200)] + [(5000, 5000), (7001, 7000), (7000, 7001)]
    edges += [(rng.randrange(8000, 8300), rng.randrange(8000, 8300)) for _ in range(200)]
    found = {r["node"]: r["root"] for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    assert found == _roots([e for e in edges if e[0] != e[1]], nodes)
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_no_pair_of_rows_leaves_a_task(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("the very same text for all").alias("text"))
    out = simhash.near_duplicates(docs)
    assert out.where("component_id = 0").count() == 3000


def test_rows_are_dropped_without_a_shuffle_of_them(spark):
    rows = spark.range(0, 1_000, numPartitions=5).selectExpr("id", "monotonically_increasing_id() AS _row", "repeat('x', 100) AS text")
    rows = simhash.store(rows, "rows")
    kept = rows.where("id % 7 = 3 OR id BETWEEN 100 AND 300")
    left = simhash._rows_kept(rows, kept.select("_row"))
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert sorted(map(tuple, left.collect())) == sorted(map(tuple, kept.collect()))
