"""Links and components against all pairs."""

import numpy as np
import pytest

from stellate.llm import queries, vectors

from . import cases

SCHEMA = "vec_id long, embedding array<float>, label int, component_id string"


def _brute(rows, cosine=0.9):
    good = {}
    for k, (_, v) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, dtype=np.float32).astype(float)
            good[k] = x / np.linalg.norm(x)
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in good:
        for j in good:
            if i < j and len(good[i]) == len(good[j]) and good[i] @ good[j] >= cosine:
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return [(key, links[i], least.get(find(i)), key == least.get(find(i))) for i, (key, _) in enumerate(rows)]


def _got(df):
    return [(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in cases.collect(df)]


def _cloud(n, d, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 8, d))
    rows = []
    for i in range(n):
        v = centres[rng.integers(len(centres))] + rng.normal(size=d) * rng.choice([0.05, 0.3, 0.5]) if i % 2 else rng.normal(size=d)
        rows.append((int(i), [float(np.float32(x)) for x in v]))
    return rows


def _recall(got, want):
    return sum(min(g[1], w[1]) for g, w in zip(got, want)) / max(1, sum(w[1] for w in want))


@pytest.mark.parametrize("d", [3, 16, 64])
def test_recall_and_precision(spark, d):
    rows = _cloud(1500, d, d)
    frame = spark.createDataFrame([(k, v, 0, "x") for k, v in rows], SCHEMA)
    got, want = sorted(_got(vectors.near_duplicates(frame))), _brute(rows)
    assert all(g[1] <= w[1] for g, w in zip(got, want))  # no link below the threshold
    assert _recall(got, want) >= 0.99


def test_query_over_all_vectors(spark):
    got = sorted(_got(queries.QUERIES["op7_product_quantisation"](spark, cases.SF)))
    rows = sorted((r[0], r[1]) for r in spark.read.parquet(f"{cases.SF}/embeddings.parquet").select("vec_id", "embedding").collect())
    assert got == sorted(_brute(rows))


def test_long_lists_are_cut(spark, monkeypatch):
    monkeypatch.setattr(vectors, "MEMBERS", 16)
    monkeypatch.setattr(vectors, "ASKED", 32)
    rng = np.random.default_rng(0)
    rows = [(i, [float(np.float32(x)) for x in np.ones(8) + rng.normal(size=8) * 0.1]) for i in range(300)]
    rows += [(300 + i, [0.0, 1.0] + [0.0] * 6) for i in range(100)]
    frame = spark.createDataFrame([(k, v, 0, "x") for k, v in rows], SCHEMA)
    assert sorted(_got(vectors.near_duplicates(frame, lists=2))) == sorted(_brute(rows))


def test_odd_and_empty_tables(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 1.0]), (8, [2.0, 2.0]), (9, [1e-30, 1e-30]),
        (10, [1e30, 1e30]), (7, [1.0, 1.0]), (None, [1.0, 0.99]), (None, [-1.0, 1.0]), (11, [1.0, 1.0, 0.0]), (12, [1.0, 1.0, 0.1]), (13, [-1.0, -1.0]),
        (14, [0.0]), (15, [5.0]), (16, [-0.0, 1.0]), (17, [0.0, 1.0]), (None, None),
    ]
    frame = spark.createDataFrame([(k, v, None, None) for k, v in rows], SCHEMA)
    assert sorted(_got(vectors.near_duplicates(frame)), key=str) == sorted([(k, n, c, k == c) for k, n, c, _ in _brute(rows)], key=str)
    assert vectors.near_duplicates(frame.limit(0)).count() == 0
    assert vectors.near_duplicates(frame.limit(1)).count() == 1


def test_centroids_need_a_bounded_number_of_distances(monkeypatch):
    x = np.random.default_rng(2).normal(size=(500, 8))
    whole = vectors.kmeans(x, 20)
    monkeypatch.setattr(vectors, "DISTANCES", 150)  # seven rows at a time
    assert np.allclose(vectors.kmeans(x, 20), whole)
