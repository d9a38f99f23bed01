"""The index against plain search, and contamination against brute force and SQL."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest

from stellate.llm import queries
from stellate.llm import decontaminate
from stellate.llm.decontaminate import contamination, find, phrases, remove_contaminated, words_of
from stellate.llm.fmindex import FMIndex, Wavelet, suffix_array

from ..compare import connect, differences
from . import cases


def _text(seed, n=600, size=4):
    seq = np.random.default_rng(seed).integers(0, size, n)
    seq[-1] = 0
    return seq


@pytest.mark.parametrize("seed", range(5))
def test_suffix_array(seed):
    seq = np.concatenate([_text(seed), [1, 2, 3] * 40, [0], [1, 2, 3] * 40, [0]])
    zeros = np.cumsum(seq == 0) - len(seq)
    keys = [tuple(int(zeros[j]) if seq[j] == 0 else int(seq[j]) for j in range(i, int(np.flatnonzero(seq[i:] == 0)[0]) + i + 1)) for i in range(len(seq))]
    assert suffix_array(seq).tolist() == sorted(range(len(seq)), key=keys.__getitem__)


def test_wavelet():
    seq = np.random.default_rng(1).integers(0, 13, 500)
    tree, at = Wavelet(seq, 4), np.arange(500)
    assert (tree.access(at) == seq).all()
    for number in range(13):
        assert (tree.rank(np.full(500, number), at) == np.append(0, np.cumsum(seq == number))[:-1]).all()


@pytest.mark.parametrize("seed", range(5))
def test_search_and_locate(seed):
    seq, rng = _text(seed), np.random.default_rng(seed + 50)
    index = FMIndex(seq, 4, sample=5)
    lengths = rng.integers(1, 6, 40)
    patterns = np.zeros((40, 6), dtype=np.int64)
    for i, n in enumerate(lengths):
        patterns[i, :n] = rng.integers(1, 4, n)
    low, high = index.search(patterns, lengths)
    at, which = index.locate(low, high)
    for i, n in enumerate(lengths):
        want = [p for p in range(len(seq) - n + 1) if (seq[p : p + n] == patterns[i, :n]).all()]
        assert sorted(at[which == i].tolist()) == want


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def _brute(rows, items):
    windows = {}
    for name, text in items:
        w = _words(text)
        for i in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[i : i + 13]), set()).add("" if name is None else str(name))
    out = []
    for doc, text in rows:
        w, hit, found = _words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= own
        out.append((doc, len(w), len(hit), ",".join(sorted(found)), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def _plain(df):
    return [(r["doc_id"], r["n_words"], r["n_hit"], ",".join(r["items"]), r["contaminated"]) for r in cases.collect(df)]


def _key(row):
    return tuple((x is not None, x or 0) if i == 0 else x for i, x in enumerate(row))


def test_query_is_its_sql(spark):
    with connect(cases.SF) as con:
        assert differences(queries.QUERIES["op4_fm_index"](spark, cases.SF), con, queries.SQL["op4_fm_index"]) == []


ITEMS = [
    (1, "the quick brown fox jumps over the lazy dog near the river bank today and more of it"), (2, "Hello, World!"), (3, "word word word"),
    (3, "a copy that is there"), (None, "no id"), (5, ""), (6, None), (7, "never anywhere found"), (8, "é́ ﬁ"),
]


@pytest.mark.parametrize("options", [{}, {"shard_words": 50}, {"block_bytes": 20}, {"block_bytes": 20, "shard_words": 1}])
def test_odd_tables_in_one_block_and_in_many(spark, options):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = contamination(cases.odd_documents(spark), items, **options)
    assert sorted(_plain(found), key=_key) == sorted(_brute([(r[0], r[1]) for r in cases.rows()], ITEMS), key=_key)
    kept = remove_contaminated(cases.odd_documents(spark), items, **options)
    assert kept.columns == cases.odd_documents(spark).columns
    assert kept.count() == sum(not r["contaminated"] for r in cases.collect(found))


def test_many_blocks_take_one_stage_and_one_block_at_a_time(spark, monkeypatch):
    sent = []
    monkeypatch.setattr(decontaminate, "phrases", lambda items, window: sent.append(len(items)) or phrases(items, window))
    items = spark.createDataFrame([(i, f"item number {i} has words of its own {i * 7}") for i in range(60)], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"before item number {i} has words of its own {i * 7} after") for i in range(0, 90, 3)], "doc_id long, text string")
    found = contamination(docs, items, block_bytes=200)
    assert len(sent) >= 10 and sum(sent) == 60 and max(sent) < 30
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert {r["doc_id"]: r["items"] for r in cases.collect(found)} == {i: [str(i)] if i < 60 else [] for i in range(0, 90, 3)}


def test_occurrences_are_compared_by_bytes():
    known = phrases([("a", "brown fox jumps"), ("b", "lazy dog")])
    words = words_of(pa.array(["the brown fox jumps", None, "a lazy dog"], pa.string()))
    table = decontaminate.Table.of(known.vocabulary)
    start, end, items = find(known, table, words)
    assert list(zip(start.tolist(), end.tolist())) == [(1, 4), (5, 7)] and [sorted(x) for x in items] == [[0], [], [1]]
    # as if another word had the hash of "fox"
    words.data[int(words.start[2])] = ord("b")
    start, end, items = find(known, table, words)
    assert list(zip(start.tolist(), end.tolist())) == [(5, 7)] and [sorted(x) for x in items] == [[], [], [1]]


def test_equal_hashes_in_the_benchmark_stop_the_run(monkeypatch):
    monkeypatch.setattr(decontaminate, "hashes", lambda data, start, end: (end - start).astype(np.uint64))
    with pytest.raises(ValueError):
        phrases([("a", "fox dog")])
    assert phrases([("a", "fox fox")]) is not None


def test_spans_are_the_words_in_the_text(spark):
    items = spark.createDataFrame([(1, "Brown fox, jumps")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "É a Brown  fox -- JUMPS over brown fox jumps.")], "doc_id long, text string")
    (row,) = cases.collect(contamination(docs, items))
    data = "É a Brown  fox -- JUMPS over brown fox jumps.".encode()
    assert [data[s["start"] : s["end"]].decode() for s in row["spans"]] == ["Brown  fox -- JUMPS", "brown fox jumps"]


def test_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert contamination(cases.no_documents(spark), items).count() == 0
    clean = contamination(cases.odd_documents(spark), items.limit(0))
    assert clean.count() == len(cases.rows()) and not clean.where("contaminated or n_hit > 0").count()


def test_no_items_hash(spark):
    out = cases.collect(queries.QUERIES["op4_fm_index"](spark, cases.SF))
    empty = hashlib.sha256(b"").hexdigest()
    assert all((r["n_items"] == 0) == (r["items_sha256"] == empty) for r in out)
