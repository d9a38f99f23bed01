"""Near-duplicate vectors by product quantisation: coarse inverted lists, residual codes, exact rerank.

Equal vectors are one class with a weight. The coarse centroids and the codebooks of the residuals' subspaces are fitted on a
bounded sample; every vector is then indexed: it belongs to the list of its nearest centroid and carries the code of its
residual and the distance ``e`` between itself and what the code stands for.

A query probes every list whose border is near enough. A neighbour with cosine ``c`` is at most ``r = sqrt(2 - 2c)`` away
(vectors are scaled to length 1), and how far that leads towards another list is the projection of that step on one
direction, whose spread is ``r / sqrt(d)`` in d dimensions. Lists whose border is within ``MARGIN`` such spreads are probed.
A pair is found from either end, and both ends count it; so it is lost only if the step crosses the border by more than
``MARGIN`` spreads on both sides, that is over twice the margin. In a list the distances to all codes come from a table per subspace, and a member stays if its distance is at most
``r + e``. As the code lies ``e`` from the member, this drops no neighbour (triangle inequality); the rest is verified
by the exact cosine. So all that the index can miss are neighbours in lists not probed; tests measure the recall.

Long lists are cut into blocks of members and of queries that meet in tasks of their own. Tasks give counts and the links
of spanning forests, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType, StructField, StructType

from ..sources.workspace import store
from .components import labelled

COSINE = 0.9
MARGIN = 2.0
#: Vectors that the index is fitted on for each list, and lists at most: the sample is 32 x 2048 vectors at most.
PER_LIST, MOST_LISTS = 32, 2048
CODES = 256
MEMBERS, ASKED = 2048, 4096
#: Distances computed at a time while centroids are fitted.
DISTANCES = 1 << 22


# ---- index -------------------------------------------------------------------------------------------------------


@dataclass
class Index:
    centroids: np.ndarray
    codebooks: list[np.ndarray]
    parts: list[slice]

    @property
    def bytes(self) -> int:
        return self.centroids.nbytes + sum(c.nbytes for c in self.codebooks)


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Number of the nearest centroid of each row, with a bounded number of distances in memory."""
    square, rows = (centroids**2).sum(axis=1), max(1, DISTANCES // max(len(centroids), 1))
    pieces = [np.argmin(square - 2 * x[at : at + rows] @ centroids.T, axis=1) for at in range(0, len(x), rows)]
    return np.concatenate(pieces) if pieces else np.zeros(0, dtype=np.int64)


def kmeans(x: np.ndarray, k: int, rounds: int = 10, seed: int = 7) -> np.ndarray:
    """At most ``k`` centroids of the rows of ``x``; empty ones go."""
    rng = np.random.default_rng(seed)
    centroids = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        own = _nearest(x, centroids)
        count = np.bincount(own, minlength=len(centroids))
        by_list = np.argsort(own, kind="stable")
        used = count[count > 0]
        total = np.add.reduceat(x[by_list], np.append(0, np.cumsum(used)[:-1]), axis=0)
        centroids = total / used[:, None]
    return centroids


def fit(sample: np.ndarray, lists: int, subspaces: int = 8, codes: int = CODES) -> Index:
    """``sample``: rows of length 1."""
    d = sample.shape[1]
    centroids = kmeans(sample, lists)
    residual = sample - centroids[_nearest(sample, centroids)]
    cuts = np.linspace(0, d, min(subspaces, d) + 1).astype(int)
    parts = [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:])]
    return Index(centroids, [kmeans(residual[:, p], codes) for p in parts], parts)


def encode(index: Index, x: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """List, codes, distance to what they stand for, and the lists to probe (the own one included) of each row."""
    gaps = np.maximum((x**2).sum(axis=1)[:, None] + (index.centroids**2).sum(axis=1) - 2 * x @ index.centroids.T, 0)
    own = np.argmin(gaps, axis=1)
    residual = x - index.centroids[own]
    codes = np.stack([_nearest(residual[:, p], c) for p, c in zip(index.parts, index.codebooks)], axis=1).astype(np.uint8)
    decoded = np.concatenate([c[codes[:, s]] for s, c in enumerate(index.codebooks)], axis=1)
    square = (index.centroids**2).sum(axis=1)
    between = np.sqrt(np.maximum(square[own][:, None] + square - 2 * index.centroids[own] @ index.centroids.T, 0))
    near = gaps - gaps[np.arange(len(x)), own][:, None] <= 2 * between * margin
    near[np.arange(len(x)), own] = True
    rows = [np.flatnonzero(r) for r in near]
    return own, codes, np.sqrt(((residual - decoded) ** 2).sum(axis=1)), rows


def candidates(index: Index, centroid: int, asked: np.ndarray, codes: np.ndarray, error: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, member) of a list whose asymmetric distance is at most ``reach`` and the member's error."""
    residual = asked - index.centroids[centroid]
    total = np.zeros((len(asked), len(codes)))
    for s, (part, book) in enumerate(zip(index.parts, index.codebooks)):
        own = residual[:, part]
        table = np.maximum((own**2).sum(axis=1)[:, None] + (book**2).sum(axis=1) - 2 * own @ book.T, 0)
        total += table[:, codes[:, s]]
    return np.nonzero(total <= ((reach + error) ** 2 + 1e-9)[None, :])


# ---- search ------------------------------------------------------------------------------------------------------

ENTRY = [
    StructField("list", IntegerType()),
    StructField("codes", BinaryType()),
    StructField("error", DoubleType()),
    StructField("probes", ArrayType(IntegerType())),
]
FOUND = "a long, b long, n long"


def _unit(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that the squares neither overflow nor vanish
    return x / np.sqrt((x**2).sum(axis=1, keepdims=True))


def _entries(index: Index, margin: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                x = _unit(batch.column("embedding"))
                own, codes, error, probes = encode(index, x, margin)
                columns = [
                    batch.column("cid"), batch.column("weight"), batch.column("embedding"), pa.array(own, pa.int32()),
                    pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error), pa.array(probes, pa.list_(pa.int32())),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["cid", "weight", "embedding", "list", "codes", "error", "probes"])

    return run


class _Group:
    """Members of one block of a list, asked by batches of queries."""

    def __init__(self, index: Index, cosine: float):
        self.index, self.cosine = index, cosine
        self.reach = float(np.sqrt(2 - 2 * cosine))
        self.parts: list[pa.RecordBatch] = []
        self.ready = False

    def add(self, batch: pa.RecordBatch) -> None:
        self.parts.append(batch)

    def _prepare(self) -> None:
        table = pa.Table.from_batches(self.parts).combine_chunks()
        self.cid = table.column("cid").to_numpy()
        self.weight = table.column("weight").to_numpy()
        self.list = int(table.column("list")[0].as_py())
        self.codes = np.frombuffer(b"".join(table.column("codes").to_pylist()), dtype=np.uint8).reshape(len(self.cid), -1)
        self.error = table.column("error").to_numpy()
        self.vector = _unit(table.column("embedding").combine_chunks())
        self.probed = np.zeros((len(self.cid), len(self.index.centroids)), dtype=bool)
        probes = table.column("probes").to_pylist()
        self.probed[np.repeat(np.arange(len(probes)), [len(p) for p in probes]), np.concatenate([np.array(p, dtype=np.int64) for p in probes])] = True
        self.count = np.zeros(len(self.cid), dtype=np.int64)
        self.root: dict[int, int] = {}
        self.ready = True

    def _find(self, i: int) -> int:
        root = self.root
        while (up := root.setdefault(i, i)) != i:
            root[i] = root[up]
            i = up
        return i

    def ask(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        if not self.ready:
            self._prepare()
        step = max(16, (1 << 20) // max(1, len(self.cid)))
        for at in range(0, batch.num_rows, step):
            own = batch.slice(at, step)
            cid, weight, lists = (own.column(c).to_numpy() for c in ("cid", "weight", "list"))
            vector = _unit(own.column("embedding"))
            q, m = candidates(self.index, self.list, vector, self.codes, self.error, self.reach)
            other = cid[q] != self.cid[m]
            q, m = q[other], m[other]
            close = [np.einsum("ij,ij->i", vector[q[i : i + 65536]], self.vector[m[i : i + 65536]]) >= self.cosine for i in range(0, len(q), 65536)]
            good = np.concatenate(close) if close else np.zeros(0, dtype=bool)
            q, m = q[good], m[good]
            links = np.bincount(q, weights=self.weight[m], minlength=len(cid)).astype(np.int64)
            blind = ~self.probed[m, lists[q]]  # the member does not ask this query's list
            np.add.at(self.count, m[blind], weight[q[blind]])
            a, b = [], []
            for x, y in zip(cid[q].tolist(), self.cid[m].tolist()):
                r, s = self._find(x), self._find(y)
                if r != s:
                    self.root[max(r, s)] = min(r, s)
                    a.append(x)
                    b.append(y)
            some = np.flatnonzero(links)
            yield _rows(a + cid[some].tolist(), b + [None] * len(some), [0] * len(a) + links[some].tolist())

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.ready and self.count.any():
            some = np.flatnonzero(self.count)
            yield _rows(self.cid[some].tolist(), [None] * len(some), self.count[some].tolist())


def _rows(a: list, b: list, n: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (a, b, n)], ["a", "b", "n"])


def _search(index: Index, cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group = None, _Group(index, cosine)
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column("g").to_numpy(), batch.column("role").to_numpy()], axis=1)
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                g, role = key[a].tolist()
                if g != now:
                    yield from group.rest()
                    now, group = g, _Group(index, cosine)
                if role == 0:
                    group.add(batch.slice(a, b - a))
                else:
                    yield from group.ask(batch.slice(a, b - a))
        yield from group.rest()

    return run


def _links(classes: DataFrame, cosine: float, margin: float, lists: int | None) -> DataFrame:
    """Counts (b null) and links of the classes of one dimension: cid, weight, embedding."""
    session = classes.sparkSession
    n = classes.count()
    if n < 2:
        return session.createDataFrame([], FOUND)
    lists = min(MOST_LISTS, lists or 1 << round(np.log2(2 * np.sqrt(n))))
    share = min(1.0, PER_LIST * lists / n)
    # expected PER_LIST x lists rows, at most 65,536: the sample that the index is fitted on
    chosen = classes.where(F.pmod(F.xxhash64("embedding"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).select("embedding")
    sample = [r[0] for r in chosen.collect()] or [classes.first()["embedding"]]
    x = np.array(sample, dtype=np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    index = fit(x / np.sqrt((x**2).sum(axis=1, keepdims=True)), lists)
    reach = float(np.sqrt(2 - 2 * cosine)) * min(1.0, margin / np.sqrt(x.shape[1]))
    kind = StructType([*[classes.schema[c] for c in ("cid", "weight", "embedding")], *ENTRY])
    entries = store(classes.mapInArrow(_entries(index, reach), kind), "entries")
    asked = entries.select("*", F.explode("probes").alias("at"))
    # a row per list, of which there are MOST_LISTS at most
    sizes = entries.groupBy("list").agg(F.count("*").alias("n")).select(F.col("list").alias("at"), F.ceil(F.col("n") / MEMBERS).alias("mb"))
    queries = asked.groupBy("at").agg(F.count("*").alias("n")).select("at", F.ceil(F.col("n") / ASKED).alias("qb"))
    blocks = F.broadcast(store(sizes.join(queries, "at"), "blocks"))
    spread = F.pmod(F.xxhash64("cid"), F.col("mine")).cast("long")
    g = F.col("at").cast("long") * (1 << 40) + F.col("i") * (1 << 20) + F.col("j")
    kept = ["cid", "weight", "list", "codes", "error", "probes", "embedding"]
    members = (
        entries.withColumn("at", F.col("list")).join(blocks, "at").withColumn("mine", F.col("mb")).withColumn("i", spread)
        .withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("qb") - 1)))
        .select(g.alias("g"), F.lit(0).cast("long").alias("role"), *kept)
    )
    nothing = [F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("double").alias("error"), F.lit(None).cast("array<int>").alias("probes")]
    asking = (
        asked.join(blocks, "at").withColumn("mine", F.col("qb")).withColumn("j", spread)
        .withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("mb") - 1)))
        .select(g.alias("g"), F.lit(1).cast("long").alias("role"), "cid", "weight", "list", *nothing, "embedding")
    )
    met = members.unionByName(asking).repartition("g").sortWithinPartitions("g", "role")
    return met.mapInArrow(_search(index, cosine), FOUND)


# ---- operator ----------------------------------------------------------------------------------------------------


def near_duplicates(rows: DataFrame, key: str = "vec_id", column: str = "embedding", cosine: float = COSINE, margin: float = MARGIN, lists: int | None = None) -> DataFrame:
    """One row per vector: ``key``, ``n_links`` (other rows linked directly), ``component_id`` (least ``key`` reachable by
    links, the own one included) and ``kept`` (``key`` is that least one).

    Rows link if their cosine is at least ``cosine``. Vectors that are null, empty, zero or have null or non-finite
    components link with nothing, nor do vectors of different lengths. Repeated rows count each; null keys take part and
    give no component. Equal vectors are linked without a comparison. An empty table gives no rows.
    """
    v = F.col("embedding")
    good = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    table = rows.select(F.col(key).alias("_key"), F.col(column).alias("embedding")).withColumn("_good", F.coalesce(good, F.lit(False)))
    classes = table.where("_good").groupBy("embedding").agg(F.count("*").alias("weight"), F.min("_key").alias("least"))
    classes = store(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    found = classes.sparkSession.createDataFrame([], FOUND)
    for d in sorted(r[0] for r in classes.select(F.size("embedding")).distinct().collect()):
        found = found.unionByName(_links(classes.where(F.size("embedding") == d).select("cid", "weight", "embedding"), cosine, margin, lists))
    found = store(found, "links")
    counts = found.where("b is null").groupBy("a").agg(F.sum("n").alias("n")).withColumnRenamed("a", "cid")
    known = labelled(classes.select("cid", "least"), "cid", "least", found.where("b is not null").select("a", "b")).select("cid", "component_id")
    by_class = (
        classes.join(counts, "cid", "left").join(known, "cid")
        .select("embedding", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    )
    linked = table.where("_good").join(by_class, "embedding").select("_key", "n_links", "component_id")
    alone = table.where("not _good").select("_key", F.lit(0).cast("long").alias("n_links"), F.col("_key").alias("component_id"))
    return linked.unionByName(alone).select(F.col("_key").alias(key), "n_links", "component_id", F.col("_key").eqNullSafe(F.col("component_id")).alias("kept"))
