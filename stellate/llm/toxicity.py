"""Toxicity by a classifier chain.

Categories are predicted one after the other, from the severest to the widest: ``severe``, ``repeated``, ``toxic``. Each has a
linear (logistic) model over the document's features and the probabilities of the categories before it. While training,
those probabilities are out-of-fold predictions, so that no model learns from an earlier one that has seen its row.

``toxic`` is the given label. The two others are derived from it: a toxic document with several different indicating words.
Features are a document's words and their beginnings and ends of several lengths, hashed; those are kept that labelled toxic
documents have far more often than others. For the predictions of a fold the features, and with them the indicating words, are
chosen without the labels of that fold. A category is never likelier than the wider ones that contain it. All models are fitted on at most ``TRAIN_ROWS`` labelled documents (a sample by
the hash of their ids); every whole text is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from ..sources.workspace import store
from .arrow import offsets, slices
from .columns import neutral
from .sample import labelled
from .words import Table, buffer_of, hashes, runs

CATEGORIES = ("severe", "repeated", "toxic")
#: Different indicating words that make a toxic document repeated or severe.
REPEATED, SEVERE = 2, 4
TRAIN_ROWS, FOLDS = 40_000, 5
BITS = 20
BUCKETS = 1 << BITS
#: Beginnings (positive) and ends (negative) of words in bytes; 0 is the whole word.
PIECES = (0, 3, 4, 5, 6, -4, -5, -6)
#: A feature is kept if so many toxic documents have it, also as a share of them, and at so many times the odds of others.
LEAST_DOCUMENTS, LEAST_SHARE, LEAST_LOG_ODDS, MOST_FEATURES = 3, 0.004, 3.0, 16_384
KEPT_WORDS = 1_000_000
PARTS = 16
CHUNK = 1 << 20

_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# ---- features ----------------------------------------------------------------------------------------------------


class Words:
    """Features of the words of many texts; a word's features are computed when it is first met."""

    def __init__(self, chosen: np.ndarray | None = None):
        """``chosen``: number of each bucket among the kept features, or -1; without it, buckets are the features."""
        self.chosen = chosen
        self._clear()

    def _clear(self) -> None:
        self.table = Table()
        self.features = np.zeros((1 << 12, len(PIECES)), dtype=np.int32)

    def read(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of each word, and the number of the first word of each text."""
        if self.table.size > KEPT_WORDS:
            self._clear()
        data, at = buffer_of(column)
        data = _LOWER[data]
        start, end = runs(_WORD[data])
        rows, new = self.table.number(hashes(data, start, end))
        if len(new):
            ordered = np.argsort(new)
            a, b = start[new][ordered], end[new][ordered]
            found = np.empty((len(new), len(PIECES)), dtype=np.int64)
            for k, piece in enumerate(PIECES):
                first = a if piece >= 0 else np.maximum(a, b + piece)
                last = b if piece <= 0 else np.minimum(b, a + piece)
                mixed = (hashes(data, first, last) ^ np.uint64(k + 1)) * np.uint64(0xBF58476D1CE4E5B9)
                bucket = (mixed >> np.uint64(64 - BITS)).astype(np.int64)
                bucket[b - a < abs(piece)] = -1  # shorter words don't have the piece
                found[ordered, k] = bucket
            if self.chosen is not None:
                found = np.where(found >= 0, self.chosen[found], -1)
            to = self.table.size
            while to > len(self.features):
                self.features = np.concatenate([self.features, np.zeros_like(self.features)])
            self.features[to - len(new) : to] = found
        return rows, np.searchsorted(start, at)

    def documents(self, column: pa.Array, sets: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each text's different features, one text after the other; where each text's begin; how many different words of a
        text have a feature. With ``sets`` (a row per set, whether a feature is in it), a column for each set's features."""
        rows, first = self.read(column)
        n = len(first) - 1
        text = np.repeat(np.arange(n), np.diff(first))
        some = (self.features[: max(self.table.size, 1)] >= 0).any(axis=1)
        hit = np.flatnonzero(some[rows]) if len(rows) else np.zeros(0, dtype=np.int64)
        pairs = np.unique((text[hit] << 32) | rows[hit])
        text, rows = pairs >> 32, pairs & 0xFFFFFFFF
        found = self.features[rows]
        keep = found >= 0
        if sets is None:
            words = np.bincount(text, minlength=n)
        else:
            words = np.stack([np.bincount(text[(own[found] & keep).any(axis=1)], minlength=n) for own in sets], axis=1)
        pairs = np.unique((np.repeat(text, keep.sum(axis=1)) << 32) | found[keep])
        return pairs & 0xFFFFFFFF, np.searchsorted(pairs >> 32, np.arange(n + 1)), words


# ---- linear models -----------------------------------------------------------------------------------------------


@dataclass
class Rows:
    """Sparse binary features of some documents, and dense ones beside them."""

    features: np.ndarray
    at: np.ndarray
    width: int

    @property
    def n(self) -> int:
        return len(self.at) - 1

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), np.diff(self.at))

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row_of(), weights=weights[self.features], minlength=self.n)

    def back(self, error: np.ndarray) -> np.ndarray:
        return np.bincount(self.features, weights=error[self.row_of()], minlength=self.width)

    def take(self, rows: np.ndarray) -> "Rows":
        length = np.diff(self.at)[rows]
        pieces = [self.features[self.at[r] : self.at[r + 1]] for r in rows.tolist()]
        return Rows(np.concatenate(pieces) if pieces else self.features[:0], offsets(length), self.width)


    def only(self, kept: np.ndarray) -> "Rows":
        """Without the features that are not in ``kept`` (true or false for each)."""
        keep = kept[self.features]
        return Rows(self.features[keep], offsets(np.bincount(self.row_of()[keep], minlength=self.n)), self.width)


@dataclass
class Linear:
    weights: np.ndarray
    dense: np.ndarray
    bias: float

    def probability(self, rows: Rows, dense: np.ndarray) -> np.ndarray:
        z = rows.times(self.weights) + dense @ self.dense + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def train(rows: Rows, dense: np.ndarray, y: np.ndarray, decay: float = 1e-4, steps: int = 300) -> Linear:
    """Logistic regression by Adam over all rows. With one label only: its smoothed share."""
    bias = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    out = Linear(np.zeros(rows.width), np.zeros(dense.shape[1]), bias)
    if not 0 < y.sum() < len(y):
        return out
    values = np.concatenate([out.weights, out.dense, [bias]])
    first, second = np.zeros_like(values), np.zeros_like(values)
    w = rows.width
    for step in range(1, steps + 1):
        p = Linear(values[:w], values[w:-1], values[-1]).probability(rows, dense)
        error = (p - y) / len(y)
        slope = np.concatenate([rows.back(error), dense.T @ error, [error.sum()]])
        slope[:-1] += decay * values[:-1]
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        values -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return Linear(values[:w], values[w:-1], float(values[-1]))


@dataclass
class Chain:
    models: list[Linear]
    threshold: float

    def probabilities(self, rows: Rows, words: np.ndarray) -> np.ndarray:
        """One column per category."""
        dense = np.log1p(words)[:, None].astype(np.float64)
        for model in self.models:
            dense = np.concatenate([dense, model.probability(rows, dense)[:, None]], axis=1)
        # a category is a part of the next one
        return np.minimum.accumulate(dense[:, :0:-1], axis=1)[:, ::-1]


def train_models(rows: Rows, words: np.ndarray, labels: list[np.ndarray], folds: np.ndarray, sets: np.ndarray | None = None) -> tuple[list[Linear], np.ndarray]:
    """One model per category and the out-of-fold predictions, a column per category.

    ``words`` and each category's ``labels`` (in the chain's order) have a column per fold, as they are by the features chosen
    without it, and one by the features chosen from all folds; or one vector where they are the same. ``sets`` tells in the
    same order which features were chosen.
    """
    wide = lambda x: x if x.ndim == 2 else np.repeat(x[:, None], FOLDS + 1, axis=1)
    views = [rows if sets is None else rows.only(own) for own in (range(FOLDS + 1) if sets is None else sets)]
    count, before, models = np.log1p(wide(words)).astype(np.float64), np.zeros((rows.n, 0)), []
    for given in labels:
        y, outside = wide(given), np.zeros(rows.n)
        for fold in range(FOLDS):
            test, rest = np.flatnonzero(folds == fold), np.flatnonzero(folds != fold)
            dense = np.concatenate([count[:, fold : fold + 1], before], axis=1)
            if len(test) and len(rest):
                outside[test] = train(views[fold].take(rest), dense[rest], y[rest, fold]).probability(views[fold].take(test), dense[test])
        models.append(train(views[-1], np.concatenate([count[:, -1:], before], axis=1), y[:, -1]))
        before = np.concatenate([before, outside[:, None]], axis=1)
    return models, before


def train_chain(rows: Rows, words: np.ndarray, labels: list[np.ndarray], folds: np.ndarray, sets: np.ndarray | None = None) -> Chain:
    """The models of ``train_models``, and as threshold the best F1 out of fold for the last category."""
    models, outside = train_models(rows, words, labels, folds, sets)
    y = labels[-1] if labels[-1].ndim == 1 else labels[-1][:, -1]
    score = outside[:, -1]
    grid = np.linspace(0.05, 0.95, 19)
    f1 = [2 * (y * (score >= t)).sum() / max(1, y.sum() + (score >= t).sum()) for t in grid]
    best = np.flatnonzero(np.array(f1) >= max(f1) - 1e-12)
    return Chain(models, float(grid[best[len(best) // 2]]) if y.sum() else float("inf"))


# ---- fit and apply -----------------------------------------------------------------------------------------------


def _counts(known: DataFrame) -> np.ndarray:
    """Documents with each feature: by fold, without and with the label."""
    cells = FOLDS * 2 * BUCKETS
    width = cells // PARTS

    def rows(total: np.ndarray, at: int) -> Iterator[pa.RecordBatch]:
        """The counts that are not zero, cut into parts; ``at`` is the number of the first cell."""
        there = np.flatnonzero(total)
        for part in np.unique((there + at) // width).tolist():
            low, high = np.searchsorted(there + at, [part * width, (part + 1) * width])
            own = there[low:high]
            cell, count = (own + at - part * width).astype(np.int32), total[own].astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([cell.tobytes()], pa.binary()), pa.array([count.tobytes()], pa.binary())], ["part", "cells", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, total = Words(), np.zeros(cells, dtype=np.int32)
        for batch in slices(batches, "text", CHUNK):
            features, at, _ = words.documents(batch.column("text"))
            group = 2 * batch.column("fold").to_numpy().astype(np.int64) + batch.column("label").to_numpy()
            cell, times = np.unique(np.repeat(group, np.diff(at)) * BUCKETS + features, return_counts=True)
            total[cell] += times.astype(np.int32)
        yield from rows(total, 0)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, cell, counts in zip(*(batch.column(c).to_pylist() for c in ("part", "cells", "counts"))):
                own = sums.setdefault(part, np.zeros(width, dtype=np.int32))
                own[np.frombuffer(cell, dtype=np.int32)] += np.frombuffer(counts, dtype=np.int32)
        for part, own in sums.items():
            yield from rows(own, part * width)

    kind = "part int, cells binary, counts binary"
    out = np.zeros(cells, dtype=np.int32)
    # FOLDS x 2 x BUCKETS counts at most: 40 MB, and as many places
    for part, cell, counts in known.mapInArrow(count, kind).repartition("part").mapInArrow(add, kind).toLocalIterator():
        out[part * width + np.frombuffer(cell, dtype=np.int32)] = np.frombuffer(counts, dtype=np.int32)
    return out.reshape(FOLDS, 2, BUCKETS)


def choose(counts: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """Buckets kept as features. ``documents``: how many there are without and with the label."""
    clean, toxic = counts[0] + 0.5, counts[1] + 0.5
    odds = np.log(toxic / (documents[1] + 1 - toxic)) - np.log(clean / (documents[0] + 1 - clean))
    least = max(LEAST_DOCUMENTS, LEAST_SHARE * documents[1])
    good = np.flatnonzero((counts[1] >= least) & (odds >= LEAST_LOG_ODDS))
    return good[np.argsort(-(odds * np.sqrt(toxic))[good], kind="stable")[:MOST_FEATURES]]


@dataclass
class Sample:
    """Labelled documents as the chain learns from them; the features chosen from all folds come first."""

    buckets: np.ndarray  # of each feature
    sets: np.ndarray
    rows: Rows
    words: np.ndarray
    toxic: np.ndarray
    folds: np.ndarray

    def labels(self) -> list[np.ndarray]:
        """Of each category, as ``train_models`` takes them."""
        toxic = np.repeat(self.toxic[:, None], FOLDS + 1, axis=1)
        return [toxic * (self.words >= SEVERE), toxic * (self.words >= REPEATED), toxic]


def _numbers(buckets: np.ndarray) -> np.ndarray:
    """Number of each bucket among the kept ones, or -1."""
    out = np.full(BUCKETS, -1, dtype=np.int32)
    out[buckets] = np.arange(len(buckets))
    return out


def gather(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "toxic", rows: int = TRAIN_ROWS) -> Sample:
    """At most about ``rows`` labelled documents, with the features chosen without each fold and from all."""
    sample = labelled(docs, labels, key, label, rows)
    texts = docs.select(F.col(key).alias("key"), F.col("text").cast("string").alias("text"))
    # the sampled labels are about TRAIN_ROWS rows of two numbers, whatever the corpus
    known = texts.join(F.broadcast(sample), "key").select("key", "label", "text")
    known = store(known.withColumn("fold", F.pmod(F.xxhash64(F.col("key").cast("string")), F.lit(FOLDS)).cast("int")), "labelled")
    documents = np.zeros((FOLDS, 2), dtype=np.int64)
    for fold, value, n in known.groupBy("fold", "label").count().collect():
        documents[fold, value] = n
    counts = _counts(known)
    whole, every = counts.sum(axis=0, dtype=np.int64), documents.sum(axis=0)
    kept = [choose(whole - counts[k], every - documents[k]) for k in range(FOLDS)] + [choose(whole, every)]
    buckets = np.concatenate([kept[-1], np.setdiff1d(np.concatenate(kept), kept[-1])])
    numbers = _numbers(buckets)
    sets = np.zeros((FOLDS + 1, len(buckets)), dtype=bool)
    for own, chosen in zip(sets, kept):
        own[numbers[chosen]] = True

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(numbers)
        for batch in slices(batches, "text", CHUNK):
            features, at, count = words.documents(batch.column("text"), sets)
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(features, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("label"), batch.column("fold"), lists, pa.array(list(count), pa.list_(pa.int64()))], ["key", "label", "fold", "features", "words"])

    kind = StructType([known.schema["key"], known.schema["label"], known.schema["fold"], StructField("features", ArrayType(IntegerType())), StructField("words", ArrayType(LongType()))])
    found = known.mapInArrow(described, kind).orderBy("key").select("label", "fold", "features", "words").collect()
    at = offsets(np.array([len(r["features"]) for r in found], dtype=np.int64))
    matrix = Rows(np.array([f for r in found for f in r["features"]], dtype=np.int64), at, len(buckets))
    words = np.array([r["words"] for r in found], dtype=np.int64).reshape(len(found), FOLDS + 1)
    toxic, fold = (np.array([r[c] for r in found], dtype=np.int64) for c in ("label", "fold"))
    return Sample(buckets, sets, matrix, words, toxic, fold)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "toxic", rows: int = TRAIN_ROWS) -> tuple[np.ndarray, Chain]:
    """Number of each bucket among the features chosen from all folds (or -1), and the chain."""
    known = gather(docs, labels, key, label, rows)
    chain = train_chain(known.rows, known.words, known.labels(), known.folds, known.sets)
    width = int(known.sets[-1].sum())  # the models of the whole sample know no others
    chain.models = [Linear(m.weights[:width], m.dense, m.bias) for m in chain.models]
    return _numbers(known.buckets[:width]), chain


def scored(docs: DataFrame, chosen: np.ndarray, chain: Chain) -> DataFrame:
    """``docs`` with a probability for each category."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, width = Words(chosen), int(chosen.max()) + 1
        for batch in slices(batches, "text", CHUNK):
            features, at, count = words.documents(batch.column("text"))
            p = chain.probabilities(Rows(features, at, width), count)
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(p[:, k]) for k in range(len(CATEGORIES))]], [*batch.schema.names, *CATEGORIES])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *[StructField(c, DoubleType()) for c in CATEGORIES]]))


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key``, the probability of each category (``severe``, ``repeated``, ``toxic``) and ``is_toxic`` for every document.

    Null and empty texts have no features and are as likely toxic as that makes them. Repeated rows are scored each. A label
    that is repeated counts as toxic if one of them does; ids that several documents have are not learned from. Without labelled toxic documents nothing is toxic. An empty table
    gives no rows.
    """
    chosen, chain = fit(docs, labels, key)
    out = scored(docs.select(F.col(key), F.col("text").cast("string").alias("text")), chosen, chain)
    return out.select(key, *CATEGORIES, (F.col("toxic") >= chain.threshold).alias("is_toxic"))


def keep_clean(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` that are not toxic, with its columns.

    Null, empty and very long texts are scored like others, whole; repeated rows and ids are kept or dropped each.
    Without labelled toxic documents nothing is toxic. An empty table gives no rows. Columns may have any name.
    """
    chosen, chain = fit(docs, labels, key)
    plain, back = neutral(docs, "text")
    return back(scored(plain, chosen, chain).where(F.col("toxic") < chain.threshold))
