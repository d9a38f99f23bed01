"""Tiles of labels and references against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stellate.operators import fuzzy, nearest

from .test_fuzzy import brute_force, levenshtein


def random_names(rng, n, letters="abcdefghijkl", longest=14):
    return ["".join(rng.choice(letters) for _ in range(rng.randint(1, longest))) + rng.choice(["", " xy", " é日"]) for _ in range(n)]


@pytest.mark.parametrize("longest", [14, 30, 60])
def test_distances(longest):
    rng = random.Random(longest)
    labels, refs = random_names(rng, 30, longest=longest) + [""], random_names(rng, 40, longest=longest + 20)
    block = nearest.Block(labels, [[] for _ in labels], [0] * len(labels))
    codes, lens = nearest._codes(refs)
    ids = np.ascontiguousarray(block._ids(codes)[0].T)
    for r, n in enumerate(lens.tolist()):
        got = block.distances(np.arange(len(labels)), np.full(len(labels), r), n, ids)
        assert got.tolist() == [levenshtein(l, refs[r]) for l in labels]


@pytest.mark.parametrize("min_score", [30, None])
def test_random_names(spark, monkeypatch, min_score):
    """Names without a near reference meet the list once per block of labels: no copy of the list for each of many salts."""
    rng = random.Random(3)
    refs = sorted(set(random_names(rng, 300)))
    labels = sorted(set(random_names(rng, 90)) | {"", "??", "qqqq", "z" * 70, "abc " * 20})
    monkeypatch.setattr(nearest, "BLOCK_LABELS", 40)
    monkeypatch.setattr(nearest, "PART_ROWS", 100)
    df = spark.createDataFrame([(l,) for l in labels], "label string")
    ref = spark.createDataFrame([(r,) for r in refs], "name string")
    out = fuzzy.match_labels(df, "label", ref, "name", min_score, max_packed=0, compared="n").collect()
    assert {r.label: (r.match, r.score) for r in out} == {l: brute_force(l, refs, min_score) for l in labels}
    assert all(r.n <= len(refs) + 1 for r in out if len(r.label) < 60 and min_score)


def test_references_are_copied_once_per_block(spark):
    side = lambda n, c: spark.range(n).select(F.concat(F.lit(c), "id").alias("norm"))
    ready = lambda df: df.withColumns({"words": F.array("norm"), "len": F.length("norm"), "value": F.col("norm"), "floor": F.lit(0)})
    met = nearest.nearest(ready(side(50, "l")).drop("value"), ready(side(200, "r")).drop("floor"), 200).collect()
    assert len(met) == 50 and {r.best.neg_score <= 0 for r in met} == {True}


def hashed_names(rng, n):
    letters = "abcdefghijklmnopqrstuvwxyz0123456789"
    return sorted({"".join(rng.choice(letters) for _ in range(5)) + " " + "".join(rng.choice(letters) for _ in range(9)) for _ in range(n)})


@pytest.mark.parametrize("longest", [14, 30, 60])
def test_bounds_of_all_pairs(longest):
    """The exact distances, and bounds that hold; references may be longer than labels and numbers of one byte."""
    rng = random.Random(longest)
    labels = random_names(rng, 30, longest=longest) + [""]
    refs = sorted(random_names(rng, 40, longest=longest + 20) + ["a" * 300], key=len)
    block = nearest.Block(labels, [[] for _ in labels], [0] * len(labels))
    codes, lens = nearest._codes(refs)
    ids, known = block._ids(codes)
    steps = np.ascontiguousarray(ids.T)
    exact = [[max(len(l), len(r)) - levenshtein(l, r) for l in labels] for r in refs]
    assert block.unchanged(steps, lens).tolist() == exact
    in_order, in_any_order = block.in_order(steps, lens), block._in_any_order(ids, known)
    assert (in_order >= np.array(exact)).all() and (in_any_order >= in_order).all()
    block.floor[:] = 90
    assert block._least(300).max() == 127  # no text of 64 characters has so many in common


def test_random_names_are_not_measured_pair_by_pair(monkeypatch):
    """Most pairs of random strings pass every bound, so they are measured for all labels of a block at once."""
    single = []
    distances = nearest.Block.distances
    monkeypatch.setattr(nearest.Block, "distances", lambda self, label, *more: single.append(len(label)) or distances(self, label, *more))
    rng = random.Random(4)
    labels, refs = hashed_names(rng, 150), hashed_names(rng, 400)
    (block,) = nearest._blocks(labels, [l.split() for l in labels], [0] * len(labels))
    nearest._streamed(block, refs, [r.split() for r in refs], refs, 0)
    assert sum(single) < 0.05 * len(labels) * len(refs)
    for i in range(0, len(labels), 10):
        match, score = brute_force(labels[i], refs, None)
        assert (block.values[i], block.best[i] // 128) == (match, score)


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyz", "ab"])
def test_near_names_are_found_by_their_trigrams(monkeypatch, letters):
    """Without a look at the other pairs; where trigrams are common, as with two letters, all pairs are bounded."""
    bounded = []
    common = nearest.Block._common
    monkeypatch.setattr(nearest.Block, "_common", lambda self, *args: bounded.append(self.grams is not None) or common(self, *args))
    monkeypatch.setattr(nearest, "TOO_MANY", (0.5, 0.5))  # of few pairs many are near
    rng = random.Random(7)
    refs = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(3, 24))) for _ in range(600)}, key=len)
    labels = [r[:i] + rng.choice(letters) + r[i + 1 :] for r in refs[::8] for i in [rng.randrange(len(r))]]
    labels = sorted({l[: -rng.randint(1, 3)] if len(l) > 14 else l for l in labels} - set(refs), key=len)
    blocks = nearest._blocks(labels, [[l] for l in labels], [75] * len(labels))
    for block in blocks:
        nearest._streamed(block, refs, [[r] for r in refs], refs, 0)
        for i, label in enumerate(block.norms):
            match, score = brute_force(label, refs, 75)
            assert (block.values[i], block.best[i] // 128 if match else None) == (match, score)
    assert any(block.grams is not None for block in blocks) and any(bounded) == (letters == "ab")


def test_where_trigrams_suffice():
    assert all(nearest._grams_suffice(n, fuzzy.NEAR) for n in range(9, nearest.LONGEST + 1))
    assert not nearest._grams_suffice(8, fuzzy.NEAR) and not nearest._grams_suffice(15, 40) and not nearest._grams_suffice(15, 0)


def test_blocks_are_bounded():
    """However few tasks there are, and however many characters; labels of one size of words come together."""
    blocks, parts = nearest._dealt(1_000_000, 10_000_000, 8)
    assert blocks * nearest.MOST_LABELS >= 1_000_000 and parts * nearest.MOST_ROWS >= 10_000_000
    assert nearest._dealt(1, 1, 200) == (1, 1) and nearest._dealt(0, 0, 8)[1] == 1
    norms = sorted([chr(0x4E00 + i) * 10 for i in range(3000)] + ["b" * 17, "c" * 40], key=len)
    made = nearest._blocks(norms, [[] for _ in norms], [0] * len(norms))
    assert [n for b in made for n in b.norms] == norms and made[-1].norms == ["c" * 40] and made[-2].norms == ["b" * 17]
    old, nearest.TABLE_BYTES = nearest.TABLE_BYTES, 1 << 20
    try:
        assert max(b.places.nbytes for b in nearest._blocks(norms, [[] for _ in norms], [0] * len(norms))) <= 1 << 20
    finally:
        nearest.TABLE_BYTES = old


def test_every_unit_has_a_partition(spark, monkeypatch):
    """Hashed into the session's number of partitions, some tasks got several units of work and others none."""
    monkeypatch.setattr(nearest, "BLOCK_LABELS", 10)
    monkeypatch.setattr(nearest, "PART_ROWS", 10)
    side = lambda n, c: spark.range(n).select(F.concat(F.lit(c), "id").alias("norm"))
    ready = lambda df: df.withColumns({"words": F.array("norm"), "len": F.length("norm"), "value": F.col("norm"), "floor": F.lit(0)})
    met = nearest.nearest(ready(side(500, "l")).drop("value"), ready(side(200, "r")).drop("floor"), 200)
    blocks, parts = nearest._dealt(500, 200, 8)
    assert blocks * parts > 8 and met.rdd.getNumPartitions() == blocks * parts
