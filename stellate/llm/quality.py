"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network with calibrated scores.

Tokens are runs of word characters and runs of punctuation, lower-cased, hashed into ``BUCKETS`` buckets. A bucket has a
sparse random index vector; its word vector is that plus the (scaled) sum of the index vectors of all its neighbours within
two tokens, gathered over every text. The vectors of all buckets take a fixed amount of memory whatever the corpus, so they
can be sent to the tasks. A document is the mean of its tokens' vectors, of those of the markers for words in capitals and
words that repeat the one before, and the share of each marker.

The network is fitted on at most ``TRAIN_ROWS`` labelled documents (a sample by the hash of their ids) and its temperature on
a part of them that it has not seen. It never sees labels, language, source or ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StructField, StructType

from . import sums
from .arrow import slices
from .columns import neutral
from .sample import labelled
from .words import buffer_of, hashes, runs

BUCKET_BITS, SIZE, NONZERO, WINDOW = 15, 64, 2, 2
BUCKETS = 1 << BUCKET_BITS
#: Markers have buckets of their own behind the others.
CAPITALS, REPEATED = BUCKETS, BUCKETS + 1
ROWS = BUCKETS + 2
BLOCK = 512
TRAIN_ROWS = 20_000
THRESHOLD = 0.3
GATHERED = 1 << 16
CHUNK = 1 << 19

_KIND = np.zeros(256, dtype=np.uint8)
_KIND[33:127] = 2
_KIND[[c for c in range(128) if chr(c).isalnum()] + list(range(128, 256))] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# ---- tokens and vectors ------------------------------------------------------------------------------------------


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each token, whether it is a word in capitals, whether it repeats the token before, and the number of the
    first token of each text."""
    data, at = buffer_of(column)
    low = _LOWER[data]
    kind = _KIND[low]
    cut = np.zeros(len(kind), dtype=bool)
    cut[1:] = kind[1:] != kind[:-1]
    start, end = runs(kind > 0, cut)
    hashed = hashes(low, start, end)
    first = np.searchsorted(start, at)
    upper = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data >= 65) & (data <= 90), out=upper[1:])
    small = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data >= 97) & (data <= 122), out=small[1:])
    capitals = (upper[end] - upper[start] >= 2) & (small[end] == small[start])
    again = np.zeros(len(start), dtype=bool)
    again[1:] = (hashed[1:] == hashed[:-1]) & (kind[start[1:]] == 1)
    again[first[:-1][np.diff(first) > 0]] = False
    return (hashed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), capitals, again, first


def index_vectors(seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero components of each bucket's index vector."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, SIZE, (ROWS, NONZERO)), rng.choice([-1.0, 1.0], (ROWS, NONZERO))


def contexts(docs: DataFrame) -> np.ndarray:
    """Sum of the neighbours' index vectors for each bucket, over all texts of ``docs``."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, sign = index_vectors()
        total = np.zeros(ROWS * SIZE)
        for batch in slices(batches, "text", CHUNK):
            bucket, _, _, first = tokens(batch.column("text"))
            text = np.repeat(np.arange(len(first) - 1), np.diff(first))
            for apart in range(1, WINDOW + 1):
                same = np.flatnonzero(text[apart:] == text[:-apart])
                a, b = bucket[same], bucket[same + apart]
                for own, other in ((a, b), (b, a)):
                    for k in range(NONZERO):
                        total += np.bincount(own * SIZE + place[other, k], weights=sign[other, k], minlength=len(total))
        if total.any():
            for block, values in enumerate(np.array_split(total.reshape(ROWS, SIZE), -(-ROWS // BLOCK))):
                yield sums.part(block, values.astype(np.float32))

    parts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(gather, sums.KIND)
    whole = np.zeros((ROWS, SIZE), dtype=np.float32)
    limits = np.cumsum([0] + [len(p) for p in np.array_split(np.zeros(ROWS), -(-ROWS // BLOCK))])
    # ROWS x SIZE numbers in all: 8 MB
    for block, data in sums.added(parts, np.float32).collect():
        whole[limits[block] : limits[block + 1]] = np.frombuffer(data, dtype=np.float32).reshape(-1, SIZE)
    return whole


def word_vectors(summed: np.ndarray) -> np.ndarray:
    """Index vector plus context of length 1, for each bucket."""
    place, sign = index_vectors()
    out = np.zeros((ROWS, SIZE), dtype=np.float32)
    for k in range(NONZERO):
        np.add.at(out, (np.arange(ROWS), place[:, k]), sign[:, k])
    norm = np.linalg.norm(summed, axis=1, keepdims=True)
    return out + np.divide(summed, norm, out=np.zeros_like(summed), where=norm > 0)


def pool(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """One row per text: mean vector, share of either marker, logarithm of the number of tokens. Empty texts: zeros."""
    bucket, capitals, again, first = tokens(column)
    n = np.diff(first)
    out = np.zeros((len(n), SIZE + 3), dtype=np.float64)
    text = np.repeat(np.arange(len(n)), n)
    for at in range(0, len(bucket), GATHERED):
        own = text[at : at + GATHERED]
        starts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        out[own[starts], :SIZE] += np.add.reduceat(vectors[bucket[at : at + GATHERED]], starts, axis=0)
    for k, (flag, marker) in enumerate(((capitals, CAPITALS), (again, REPEATED))):
        count = np.bincount(text[flag], minlength=len(n))
        out[:, :SIZE] += count[:, None] * vectors[marker]
        out[:, SIZE + k] = count
    out[:, :-1] /= np.maximum(n, 1)[:, None]
    out[:, -1] = np.log1p(n) / 10
    return out


# ---- network -----------------------------------------------------------------------------------------------------


@dataclass
class Network:
    """tanh layer and logistic output over standardised inputs, with a temperature."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.tanh((x - self.mean) / self.scale @ w1 + b1) @ w2 + b2[0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x) / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def train(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 40, seed: int = 3) -> Network:
    """Fitted by Adam on four fifths of the rows; the temperature on the others. Without both labels: their share."""
    rng = np.random.default_rng(seed)
    width = x.shape[1]
    if len(np.unique(y)) < 2:
        prior = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
        return Network(np.zeros(width), np.ones(width), [np.zeros((width, 1)), np.zeros(1), np.zeros(1), np.array([prior])])
    order = rng.permutation(len(x))
    held, kept = order[: len(x) // 5], order[len(x) // 5 :]
    mean, scale = x[kept].mean(axis=0), x[kept].std(axis=0) + 1e-6
    z, target = (x[kept] - mean) / scale, y[kept].astype(np.float64)
    weights = [rng.normal(0, 1 / np.sqrt(width), (width, hidden)), np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(z)), max(1, len(z) // 256)):
            step += 1
            layer = np.tanh(z[rows] @ weights[0] + weights[1])
            error = (_sigmoid(layer @ weights[2] + weights[3][0]) - target[rows]) / len(rows)
            back = np.outer(error, weights[2]) * (1 - layer**2)
            slopes = [z[rows].T @ back + 1e-4 * weights[0], back.sum(axis=0), layer.T @ error + 1e-4 * weights[2], np.array([error.sum()])]
            for k, g in enumerate(slopes):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                weights[k] -= 0.003 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    out = Network(mean, scale, weights)
    if len(held):
        logits, truth = out.logits(x[held]), y[held].astype(np.float64)
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
        loss = [np.mean(np.logaddexp(0, logits / t) - truth * logits / t) for t in grid]
        out.temperature = float(grid[int(np.argmin(loss))])
    return out


# ---- operator ----------------------------------------------------------------------------------------------------


def held_out(key: Column) -> Column:
    """Rows never learned from: crc32 of the id as text is divisible by 5. A row without an id is one of them."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5, F.lit(0)) == 0


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", rows: int = TRAIN_ROWS) -> tuple[np.ndarray, Network]:
    """Word vectors of all texts of ``docs``, and the network fitted on labelled ones."""
    vectors = word_vectors(contexts(docs))
    chosen = labelled(docs, labels, key, label, rows, ~held_out(F.col("key")))

    def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", CHUNK):
            x = pool(batch.column("text"), vectors)
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("label"), pa.array([r.tobytes() for r in x], pa.binary())], ["key", "label", "x"])

    texts = docs.select(F.col(key).alias("key"), F.col("text").cast("string").alias("text"))
    # the chosen labels are about TRAIN_ROWS rows of two numbers, whatever the corpus
    known = texts.join(F.broadcast(chosen), "key").select("key", "label", "text")
    kind = StructType([*chosen.schema.fields, StructField("x", BinaryType())])
    found = known.mapInArrow(pooled, kind).orderBy("key").select("label", "x").collect()
    x = np.array([np.frombuffer(r["x"], dtype=np.float64) for r in found]).reshape(-1, SIZE + 3)
    return vectors, train(x, np.array([r["label"] for r in found], dtype=np.int64))


def scored(docs: DataFrame, vectors: np.ndarray, network: Network) -> DataFrame:
    """``docs`` with ``score``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", CHUNK):
            score = network.probability(pool(batch.column("text"), vectors))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())], [*batch.schema.names, "score"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("score", DoubleType())]))


def quality_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """``key``, ``held_out``, ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` of every document.

    Null and empty texts are scored like texts without tokens. Repeated ids are scored each, and not learned from; a repeated
    label counts once, the greater one. Without labels of both kinds all scores are the labels' share. An empty table gives no rows.
    """
    vectors, network = fit(docs, labels, key)
    out = scored(docs.select(F.col(key), F.col("text").cast("string").alias("text")), vectors, network)
    return out.select(key, held_out(F.col(key)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` that are predicted good, with its columns.

    Null and empty texts are scored like texts without tokens, very long ones whole; repeated rows and ids are kept or dropped
    each. Without labels of both kinds all scores are the labels' share. An empty table gives no rows. Columns may have any
    name.
    """
    vectors, network = fit(docs, labels, key)
    plain, back = neutral(docs, "text")
    return back(scored(plain, vectors, network).where(F.col("score") >= threshold))
