"""Nearest references of labels that nothing but a comparison with the whole list can settle.

Labels are dealt into blocks and references into parts. A task holds one block of labels and streams a part of the references
by it, a piece at a time. Where scores to beat are so high that texts with one of them share trigrams, only pairs that share
enough of these are looked at. Otherwise a product of two matrices gives, for all pairs at once, the characters that two texts
can have in common, which bounds the edit score from above. Where that keeps too many pairs, as for random strings, the bound
is the length of the longest common subsequence, worked out for all pairs by bit vectors: a word holds a label's column of the
table, and a reference's character meets those of all labels in one operation on arrays. Pairs that can't reach the best score
of their label so far go; the others are measured together, by Myers' bit vectors, or all pairs are where this bound keeps too
many as well. Words in common are looked up in the block. A task's memory is bounded by the block and a batch, the references
are copied once per block, and every result is exact.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from ..functions.similarity import TOKEN_WEIGHT

#: Labels of one block at least, and at most.
BLOCK_LABELS = 1024
MOST_LABELS = 32768
#: References of a part at least, and at most.
PART_ROWS = 16384
MOST_ROWS = 131072
#: References of which the likeliest of each piece is measured first.
EAGER_ROWS = 2048
#: Characters of the longest label that the bit vectors hold.
LONGEST = 64
#: Pairs whose bounds are worked out at once, and those that are measured at once.
CELLS = 1 << 21
PAIRS = 1 << 15
BUCKETS = 64
REPEATS = 4
FEATURES = 96
#: Shares of the pairs above which the characters in common, and those in the same order, don't do as a bound, and pieces
#: until they are tried again.
TOO_MANY = (1 / 16, 1 / 8)
PIECES = 32
#: Characters of the grams that near texts share.
GRAM = 3
#: Bytes of an array that stays near the processor, and of the places of all characters in a block's labels.
NEAR_BYTES = 1 << 16
TABLE_BYTES = 1 << 26


def _codes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of each text in a row padded by zeros, and the lengths."""
    lens = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    width = max(1, int(lens.max(initial=1)))
    return np.array(texts, dtype=f"<U{width}").view(np.uint32).reshape(len(texts), width), lens


def _runs(lens: np.ndarray) -> list[tuple[int, int, int]]:
    """Each value of an ascending array with the places from and up to which it stands."""
    cuts = [0, *(np.flatnonzero(lens[1:] != lens[:-1]) + 1).tolist(), len(lens)]
    return [(int(lens[a]), a, b) for a, b in zip(cuts, cuts[1:]) if a < b]


def _grams_shared(longest, floor):
    """Grams that two texts share at least if the longer one has that length and their edit score is ``floor`` or more."""
    return longest - (GRAM - 1) - GRAM * ((100 - floor) * longest // 100)


def _grams_suffice(length: int, floor: int) -> bool:
    """True if a text of that length shares a gram with all those that it scores ``floor`` with."""
    return floor > 0 and all(_grams_shared(m, floor) >= 1 for m in range(length, 100 * length // floor + 1))


class Block:
    """Labels with the best candidate that each has met."""

    def __init__(self, norms: Sequence[str], words: Sequence[Sequence[str]], floors: Sequence[int]):
        self.norms, n = norms, len(norms)
        codes, self.lens = _codes(norms)
        self.alphabet = np.unique(codes[codes != 0])
        ids, known = self._ids(codes)
        self.letters = len(self.alphabet) + 1
        kind = next(t for t in (np.uint16, np.uint32, np.uint64) if int(self.lens.max(initial=0)) <= 8 * np.dtype(t).itemsize)
        self.places = np.zeros((n, self.letters), dtype=kind)
        for j in range(codes.shape[1]):
            rows = np.flatnonzero(known[:, j])
            self.places[rows, ids[rows, j]] |= kind(1 << j)
        self.by_letter = np.ascontiguousarray(self.places.T)
        bits = np.arange(8 * np.dtype(kind).itemsize)
        self.column = np.bitwise_or.reduce(np.where(bits < self.lens[:, None], kind(1) << bits.astype(kind), kind(0)), axis=1).astype(kind)
        repeats = self._repeats(ids, known)
        used = repeats.sum(axis=0)
        self.columns = np.argsort(-used, kind="stable")[: min(FEATURES, max(1, int((used > 0).sum())))]
        self.features = np.ascontiguousarray(repeats[:, self.columns].T.astype(np.float32))
        self.rest = self.lens.astype(np.float32) - self.features.sum(axis=0)
        self.way = self.pieces = 0
        self.grams = None
        if n and all(_grams_suffice(*x) for x in {*zip(self.lens.tolist(), floors)}):
            keys = self._grams(ids)
            keys[(np.arange(keys.shape[1]) > self.lens[:, None] - GRAM)] = -1
            order = np.argsort(keys, axis=None, kind="stable")
            self.grams, self.of_gram = keys.ravel()[order], order // max(1, keys.shape[1])
        self.sizes = np.array([len(w or ()) for w in words], dtype=np.int64)
        self.holders: dict[str, list[int]] = defaultdict(list)
        for i, own in enumerate(words):
            for w in own or ():
                self.holders[w].append(i)
        self.floor = np.array(floors, dtype=np.int64)
        self.best = np.full(n, -1, dtype=np.int64)  # score * 128 + edit score
        self.values: list = [None] * n
        self.compared = np.zeros(n, dtype=np.int64)

    def _ids(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of code points in the labels' alphabet (its length for others), and which are in it."""
        if not len(self.alphabet):
            return np.zeros(codes.shape, dtype=np.int64), np.zeros(codes.shape, dtype=bool)
        at = np.minimum(np.searchsorted(self.alphabet, codes.ravel()).reshape(codes.shape), len(self.alphabet) - 1)
        known = self.alphabet[at] == codes
        return np.where(known, at, len(self.alphabet)), known

    def _repeats(self, ids: np.ndarray, known: np.ndarray) -> np.ndarray:
        """For each text and bucket of characters, if it has at least 1, 2 .. ``REPEATS`` of them."""
        row, col = np.nonzero(known)
        counts = np.bincount(row * BUCKETS + ids[row, col] % BUCKETS, minlength=len(ids) * BUCKETS).reshape(len(ids), BUCKETS)
        return (counts[:, :, None] > np.arange(REPEATS)).reshape(len(ids), BUCKETS * REPEATS)

    def _grams(self, ids: np.ndarray) -> np.ndarray:
        """A number for each three characters in a row of each text."""
        wide = np.pad(ids.astype(np.int64), ((0, 0), (0, GRAM - 1)), constant_values=self.letters - 1)
        width = ids.shape[1]
        return (wide[:, :width] * self.letters + wide[:, 1 : width + 1]) * self.letters + wide[:, 2 : width + 2]

    def _sharing(self, ids: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Label and reference of all pairs that share enough grams to reach the label's floor; None where the grams are too
        common. A gram that one text has k times and the other m times is counted k * m times."""
        if self.grams is None:
            return None
        keys = self._grams(ids)
        ref, at = np.nonzero(np.arange(keys.shape[1]) <= lens[:, None] - GRAM)
        sought = keys[ref, at]
        first, last = np.searchsorted(self.grams, sought, side="left"), np.searchsorted(self.grams, sought, side="right")
        hits = last - first
        if hits.sum() > TOO_MANY[0] * len(lens) * len(self.norms):
            return None
        place = np.arange(hits.sum()) + np.repeat(first - (np.cumsum(hits) - hits), hits)
        pairs, shared = np.unique(self.of_gram[place] + np.repeat(ref, hits) * len(self.norms), return_counts=True)
        ref, label = np.divmod(pairs, len(self.norms))
        longest = np.maximum(self.lens[label], lens[ref])
        near = shared >= _grams_shared(longest, self.floor[label])
        return label[near], ref[near]

    def _least(self, n: int) -> np.ndarray:
        """Characters that each label has in common with a reference of ``n`` characters that reaches its score to beat."""
        return np.minimum(-(-self.floor * np.maximum(self.lens, n) // 100), np.iinfo(np.int8).max)

    def _common(self, ids: np.ndarray, known: np.ndarray, lens: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, bool]:
        """Characters that a reference (row) and a label (column) have in common at most, and if that is the longer length
        less their distance. The bounds are tried from the cheapest, and one that keeps few pairs serves some more pieces."""
        if not self.pieces:
            self.way, self.pieces = 0, PIECES
            common = self._in_any_order(ids, known)
            if self._near(common, lens) > TOO_MANY[0]:
                self.way, common = 1, self.in_order(steps, lens)
                if self._near(common, lens) > TOO_MANY[1]:
                    self.way = 2
            if self.way < 2:
                return common, False
        self.pieces -= 1
        if self.way == 0:
            return self._in_any_order(ids, known), False
        return (self.in_order(steps, lens), False) if self.way == 1 else (self.unchanged(steps, lens), True)

    def _near(self, common: np.ndarray, lens: np.ndarray) -> float:
        """Share of the pairs that the bound leaves."""
        return sum(np.count_nonzero(common[a:b] >= self._least(n).astype(common.dtype)) for n, a, b in _runs(lens)) / common.size

    def _in_any_order(self, ids: np.ndarray, known: np.ndarray) -> np.ndarray:
        common = self._repeats(ids, known)[:, self.columns].astype(np.float32) @ self.features
        common += self.rest
        return common

    def _batches(self, steps: np.ndarray, lens: np.ndarray) -> Iterator[tuple[int, int, Iterator[np.ndarray]]]:
        """References by references (from, up to) of one length, as many as an array near the processor holds for all labels,
        with the places of their first, second .. characters in the labels."""
        kind, n = self.places.dtype, len(self.norms)
        rows = max(1, NEAR_BYTES // (n * kind.itemsize))
        place = np.empty((rows, n), dtype=kind)

        def places(i: int, upto: int, length: int) -> Iterator[np.ndarray]:
            for j in range(length):
                if upto == i + 1:
                    yield self.by_letter[steps[j, i]][None]
                else:
                    yield np.take(self.by_letter, steps[j, i:upto], axis=0, out=place[: upto - i], mode="clip")

        for length, a, b in _runs(lens):
            for i in range(a, b, rows):
                upto = min(i + rows, b)
                yield i, upto, places(i, upto, length)

    def _arrays(self, count: int, rows: int) -> list[np.ndarray]:
        return [np.empty((rows, len(self.norms)), dtype=self.places.dtype) for _ in range(count)]

    def in_order(self, steps: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Length of the longest common subsequence of each reference (row) and label (column). A zero bit of ``state`` is a
        place of the label at which the subsequence gets longer."""
        out = np.empty((len(lens), len(self.norms)), dtype=np.int8)
        arrays = ()
        for i, upto, places in self._batches(steps, lens):
            if not arrays or len(arrays[0]) != upto - i:
                arrays = self._arrays(3, upto - i)
            state, hit, other = arrays
            state.fill(np.iinfo(state.dtype).max)
            for same in places:
                np.bitwise_and(state, same, out=hit)
                np.bitwise_xor(state, hit, out=other)
                state += hit
                state |= other
            np.subtract(8 * state.itemsize, np.bitwise_count(state), out=out[i:upto], casting="unsafe")
        return out

    def unchanged(self, steps: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """The longer length less the edit distance of each reference (row) and label (column)."""
        out = np.empty((len(lens), len(self.norms)), dtype=np.int8)
        one, arrays = self.places.dtype.type(1), ()
        for i, upto, places in self._batches(steps, lens):
            if not arrays or len(arrays[0]) != upto - i:
                arrays = self._arrays(4, upto - i)
            up, down, x, diagonal = arrays
            up.fill(np.iinfo(up.dtype).max)
            down.fill(0)
            for same in places:
                np.bitwise_or(same, down, out=x)
                np.bitwise_and(x, up, out=diagonal)
                diagonal += up
                diagonal ^= up
                diagonal |= x
                np.bitwise_or(up, diagonal, out=x)  # higher
                np.invert(x, out=x)
                x |= down
                up &= diagonal
                up += up
                x += x
                x |= one
                np.bitwise_and(x, diagonal, out=down)
                diagonal |= x
                np.invert(diagonal, out=diagonal)
                up |= diagonal
            up &= self.column
            down &= self.column
            n = int(lens[i])
            kept = np.bitwise_count(down).astype(np.int8)
            kept -= np.bitwise_count(up).astype(np.int8)
            np.add(kept, (np.maximum(self.lens, n) - n).astype(np.int8), out=out[i:upto])
        return out

    def meet(self, norms: Sequence[str], words: Sequence[Sequence[str]], values: Sequence, eager: bool) -> None:
        """Compare all labels with some references, in ascending order of length."""
        codes, lens = _codes(norms)
        ids, known = self._ids(codes)
        steps = np.ascontiguousarray(ids.T.astype(np.int64))
        rank = np.empty(len(values), dtype=np.int64)
        rank[sorted(range(len(values)), key=values.__getitem__)] = np.arange(len(values))
        refs = (steps, lens, values, rank)
        label, ref, token = self._word_pairs(words)
        sharing = self._sharing(ids, lens)
        if sharing is not None:
            near = token >= self.floor[label]
            self._measure(label[near], ref[near], token[near], refs)
            met = label[near] * len(lens) + ref[near]
            label, ref = sharing
            new = ~np.isin(label * len(lens) + ref, met)
            self._measure(label[new], ref[new], np.zeros(int(new.sum()), dtype=np.int64), refs)
            return
        common, exact = self._common(ids, known, lens, steps)
        if exact:
            self.compared += len(lens)
        if len(label):
            longest = np.maximum(self.lens[label], lens[ref])
            near = (token >= self.floor[label]) | (common[ref, label].astype(np.int64) * 100 >= self.floor[label] * longest)
            self._measure(label[near], ref[near], token[near], refs, common if exact else None)
            common[ref, label] = -1
        if eager and not exact:  # the likeliest one first, for a score to beat
            label = np.arange(len(self.norms))
            ref = common.argmax(axis=0)
            some = common[ref, label] >= 0
            label, ref = label[some], ref[some]
            self._measure(label, ref, np.zeros(len(label), dtype=np.int64), refs)
            common[ref, label] = -1
        for n, a, b in _runs(lens):
            ref, label = np.divmod(np.flatnonzero(common[a:b] >= self._least(n).astype(common.dtype)), len(self.norms))
            self._measure(label, a + ref, np.zeros(len(label), dtype=np.int64), refs, common if exact else None)

    def _word_pairs(self, words: Sequence[Sequence[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Label, reference and word score of all pairs with a word in common."""
        labels: list[int] = []
        refs: list[int] = []
        for i, own in enumerate(words):
            for w in own or ():
                if held := self.holders.get(w):
                    labels += held
                    refs += [i] * len(held)
        width = max(1, len(words))
        keys, shared = np.unique(np.array(labels, dtype=np.int64) * width + np.array(refs, dtype=np.int64), return_counts=True)
        label, ref = np.divmod(keys, width)
        sizes = np.array([len(w or ()) for w in words], dtype=np.int64)
        smaller = np.maximum(np.minimum(self.sizes[label], sizes[ref]), 1)
        return label, ref, shared * TOKEN_WEIGHT // smaller

    def _measure(self, label: np.ndarray, ref: np.ndarray, token: np.ndarray, refs: tuple, unchanged: np.ndarray | None = None) -> None:
        ids, lens, values, rank = refs
        if unchanged is not None:
            edit = unchanged[ref, label].astype(np.int64) * 100 // np.maximum(np.maximum(self.lens[label], lens[ref]), 1)
            self._keep(label, ref, edit, token, values, rank)
            return
        self.compared += np.bincount(label, minlength=len(self.norms))
        for n in np.unique(lens[ref]):
            of = np.flatnonzero(lens[ref] == n)
            for i in range(0, len(of), PAIRS):
                some = of[i : i + PAIRS]
                l, r, t = label[some], ref[some], token[some]
                longest = np.maximum(self.lens[l], n)
                edit = (longest - self.distances(l, r, int(n), ids)) * 100 // longest
                self._keep(l, r, edit, t, values, rank)

    def distances(self, label: np.ndarray, ref: np.ndarray, n: int, ids: np.ndarray) -> np.ndarray:
        """Edit distances of pairs whose references have ``n`` characters."""
        kind = self.places.dtype.type
        places, base = self.places.ravel(), label * self.letters
        one = kind(1)
        up, down = np.full(len(label), ~kind(0)), np.zeros(len(label), dtype=kind)
        x, diagonal, higher, same, at = *(np.empty_like(up) for _ in range(4)), np.empty_like(label)
        for j in range(n):
            np.take(ids[j], ref, out=at, mode="clip")
            at += base
            np.take(places, at, out=same, mode="clip")
            np.bitwise_or(same, down, out=x)
            np.bitwise_and(x, up, out=diagonal)
            diagonal += up
            diagonal ^= up
            diagonal |= x
            np.bitwise_or(up, diagonal, out=higher)
            np.invert(higher, out=higher)
            higher |= down
            up &= diagonal
            up <<= one
            higher <<= one
            higher |= one
            np.bitwise_and(higher, diagonal, out=down)
            higher |= diagonal
            np.invert(higher, out=higher)
            up |= higher
        column = self.column[label]
        # down the last column of the table a step is +1, -1 or 0
        return n + np.bitwise_count(up & column).astype(np.int64) - np.bitwise_count(down & column)

    def _keep(self, label: np.ndarray, ref: np.ndarray, edit: np.ndarray, token: np.ndarray, values: Sequence, rank: np.ndarray) -> None:
        score = np.maximum(edit, token)
        key = score * 128 + edit
        good = np.flatnonzero((score >= self.floor[label]) & (key >= self.best[label]))
        if not len(good):
            return
        label, ref, key = label[good], ref[good], key[good]
        order = np.lexsort((rank[ref], -key, label))
        first = order[np.append(True, label[order][1:] != label[order][:-1])]
        for l, r, k in zip(label[first].tolist(), ref[first].tolist(), key[first].tolist()):
            if k > self.best[l] or values[r] < self.values[l]:
                self.best[l], self.values[l] = k, values[r]
                self.floor[l] = max(self.floor[l], k // 128)

    def found(self, schema: pa.Schema) -> pa.RecordBatch:
        met = np.flatnonzero(self.compared)
        best = [
            None if self.best[i] < 0 else {"neg_score": -int(self.best[i] // 128), "neg_edit": -int(self.best[i] % 128), "value": self.values[i]}
            for i in met
        ]
        columns = [[self.norms[i] for i in met], best, self.compared[met].tolist()]
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def _blocks(norms: Sequence[str], words: Sequence[Sequence[str]], floors: Sequence[int]) -> list[Block]:
    """Labels, in ascending order of length, as blocks whose labels have words of one size and whose tables are bounded."""
    lens = [len(x) for x in norms]
    short = 1 + max((n for n, f in {*zip(lens, floors)} if not _grams_suffice(n, f)), default=-1)
    cuts = sorted({0, *np.searchsorted(lens, [short, 17, 33]).tolist(), len(norms)})
    blocks = []
    for a, b in zip(cuts, cuts[1:]):
        size = 2 if lens[b - 1] <= 16 else 4 if lens[b - 1] <= 32 else 8
        most = NEAR_BYTES // size
        while a < b:
            n = min(most, b - a)
            if n > 1 and n * size * (1 + len(set().union(*norms[a : a + n]))) > TABLE_BYTES:
                most = n // 2
            else:
                blocks.append(Block(norms[a : a + n], words[a : a + n], floors[a : a + n]))
                a += n
    return blocks


def _compare(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, waiting, blocks, met = None, [], [], 0
        for batch in batches:
            group, kind = batch.column("g").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero((group[1:] != group[:-1]) | (kind[1:] != kind[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(group)]):
                if a == b:
                    continue
                if group[a] != now:
                    for block in blocks:
                        yield block.found(schema)
                    now, waiting, blocks, met = group[a], [], [], 0
                rows = batch.slice(a, b - a)
                if kind[a] == 0:
                    waiting.append(rows)
                elif waiting:
                    if not blocks:
                        names = ("norm", "words", "floor")
                        blocks = _blocks(*[[v for w in waiting for v in w.column(c).to_pylist()] for c in names])
                    norms, words, values = (rows.column(c).to_pylist() for c in ("norm", "words", "value"))
                    for block in blocks:
                        _streamed(block, norms, words, values, met)
                    met += len(norms)
        for block in blocks:
            yield block.found(schema)

    return run


def _streamed(block: Block, norms: Sequence[str], words: Sequence[Sequence[str]], values: Sequence, met: int) -> None:
    """The references in pieces; the first pieces of a part are short, as they give the labels their first scores to beat."""
    at = 0
    while at < len(norms):
        most = CELLS // len(block.norms)
        size = max(1, min(most, CELLS // max(1, len(norms[at])), max(256, met + at)))
        upto = min(at + size, len(norms))
        while upto > at + 1 and len(norms[upto - 1]) * (upto - at) > 2 * CELLS:  # rows ascend by length
            upto = at + (upto - at) // 2
        block.meet(norms[at:upto], words[at:upto], values[at:upto], eager=met + at < EAGER_ROWS and not block.floor.min())
        at = upto


def _dealt(n_labels: int, n_refs: int, tasks: int) -> tuple[int, int]:
    """Numbers of blocks of labels and of parts of the references, whose pairs are the units of work."""
    blocks = max(1, -(-n_labels // MOST_LABELS))
    parts = max(1, -(-n_refs // MOST_ROWS), min(-(-4 * tasks // blocks), -(-n_refs // PART_ROWS)))
    return max(blocks, min(-(-n_labels // BLOCK_LABELS), -(-2 * tasks // parts))), parts


def nearest(labels: DataFrame, refs: DataFrame, n_refs: int) -> DataFrame:
    """(norm, best, compared) of the labels (``norm`` of at most ``LONGEST`` characters, ``words``, ``len`` and the least score
    ``floor``) that met a reference (``norm``, ``value``, ``words``, ``len``); ``best`` is null where none reaches the floor.
    ``labels`` are read twice."""
    spark = labels.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks, parts = _dealt(labels.count(), n_refs, tasks)
    value = refs.schema["value"].dataType
    number = lambda n, seed: F.pmod(F.xxhash64("norm", F.lit(seed)), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    sides = []
    for df, kind, block, part in ((labels, 0, number(blocks, 1), every(parts)), (refs, 1, every(blocks), number(parts, 2))):
        sides.append(
            df.select(
                "*", block.alias("block"), part.alias("part"), F.lit(kind).alias("kind")
            ).select(
                (F.col("block") * parts + F.col("part")).alias("g"), "kind", "len", "norm", "words",
                *(["floor", F.lit(None).cast(value).alias("value")] if kind == 0 else [F.lit(0).alias("floor"), "value"]),
            )
        )
    best = StructType([StructField("neg_score", IntegerType()), StructField("neg_edit", IntegerType()), StructField("value", value)])
    schema = StructType([StructField("norm", StringType()), StructField("best", best), StructField("compared", LongType())])
    from pyspark.sql.pandas.types import to_arrow_schema

    # a partition for each unit: hashed into fewer, some tasks would get several and others none
    met = sides[0].unionByName(sides[1]).repartitionById(blocks * parts, F.col("g").cast("int")).sortWithinPartitions("g", "kind", "len")
    return met.mapInArrow(_compare(to_arrow_schema(schema)), schema)
