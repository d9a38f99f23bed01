import math
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stellate.llm import queries, whitening

from . import cases


def polynomial(m):
    """By Faddeev and LeVerrier, in fractions."""
    d = len(m)
    a, c, aux = np.array(m, dtype=object), [1], np.zeros((d, d), dtype=object)
    for k in range(1, d + 1):
        aux = a @ aux + c[-1] * np.eye(d, dtype=int).astype(object)
        c.append(Fraction(-sum((a @ aux)[i, i] for i in range(d)), k))
    return [int(x) for x in reversed(c)]


def gram(rows):
    x = np.array(rows, dtype=object)
    return (x.T @ x).tolist()


def turned(values, seed=3):
    """An integer matrix with multiples of some eigenvalues: the product of reflections is orthogonal over the rationals."""
    d = len(values)
    rng = np.random.default_rng(seed)
    q = np.array([[Fraction(int(i == j)) for j in range(d)] for i in range(d)], dtype=object)
    for _ in range(2):
        v = rng.integers(-2, 3, d).tolist()
        v[0] = 1
        q = q - np.array([[Fraction(2 * a * b, sum(x * x for x in v)) for b in v] for a in v], dtype=object) @ q
    m = q @ np.diag(np.array([Fraction(x) for x in values], dtype=object)) @ q.T
    scale = math.lcm(*[x.denominator for r in m for x in r])
    return [[int(x * scale) for x in r] for r in m], scale


def reference(vectors, most=16):
    """(n, codes, eigenvalues, components) by numpy, in doubles."""
    x = np.floor(64 * np.array(vectors, dtype=np.float64)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    centred = fit - fit.mean(axis=0)
    values, axes = np.linalg.eigh(centred.T @ centred / len(fit))
    keep = [i for i in np.argsort(-values) if values[i] > 1e-9 * values.max()][:most]
    return fit, x, values[keep], axes[:, keep]


def check(out, ids, vectors, most=16):
    fit, x, values, axes = reference(vectors, most)
    n, k = len(fit), len(values)
    total = fit.sum(axis=0).astype(object)
    assert Counter(r["vec_id"] for r in out) == Counter({i: k * c for i, c in Counter(ids).items()})
    own = {i: v for i, v in zip(ids, x)}
    white = (x - fit.mean(axis=0)) @ axes / np.sqrt(values)
    got = {(r["vec_id"], r["component"]): r for r in out}
    signs = [max((1, -1), key=lambda s: sum(s * got[i, j + 1]["whitened"] * white[a, j] for a, i in enumerate(ids))) for j in range(k)]
    for a, i in enumerate(ids):
        deviation = int(sum((n * int(v) - int(t)) ** 2 for v, t in zip(own[i], total)))
        for j in range(k):
            r = got[i, j + 1]
            assert r["n"] == n and r["deviation"] == deviation
            assert r["whitened"] == pytest.approx(signs[j] * white[a, j], rel=1e-6, abs=1e-6)
            assert r["explained"] == pytest.approx(values[j] / np.trace(np.cov(fit.T, bias=True)), rel=1e-8)
    assert len({r["identity_error"] for r in out}) == 1 and out[0]["identity_error"] < 1e-9


def test_query_against_numpy(spark):
    rows = spark.read.parquet(f"{cases.SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    out = cases.collect(queries.QUERIES["op13_exact_whitening"](spark, cases.SF))
    check(out, [r.vec_id for r in rows], [r.embedding for r in rows])


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 6).flatmap(lambda d: st.lists(st.lists(st.integers(-50, 50), min_size=d, max_size=d), min_size=1, max_size=8)))
def test_polynomial_modulo_a_prime(rows):
    m, p = gram(rows), (1 << 31) - 1
    expected = [c % p for c in polynomial(m)]
    assert whitening.polynomial_mod((np.array(m, dtype=object) % p).astype(np.int64), p).tolist() == expected


def test_polynomial_over_the_integers(spark):
    rng = np.random.default_rng(5)
    m = gram(rng.integers(-(10**6), 10**6, (20, 12)).tolist())
    assert whitening.characteristic_polynomial(spark, m) == polynomial(m)
    assert all(p % q for p in whitening.primes_above(1 << 100) for q in range(3, 46_341, 2))


@pytest.mark.parametrize("values", [[7, 5, 3, 2], [9, 9, 4, 4, 4, 1], [10**12 + 1, 10**12, 5, 0, 0], [6] * 4, [1, 0, 0]])
def test_roots_and_null_spaces(spark, values):
    """Repeated, near and vanishing eigenvalues."""
    m, scale = turned(values)
    got, axes = whitening.components(spark, m, 5)
    expected = [v * scale for v in values if v][:5]
    assert [float(v) for v in got] == pytest.approx(expected, rel=1e-15)
    v = np.array(axes)
    assert np.abs(v @ v.T - np.eye(len(v))).max() < 1e-14
    assert np.abs(np.array(m, dtype=float) @ v.T - v.T * np.array(expected, dtype=float)).max() < 1e-13 * max(expected)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_repeats_count_once(spark):
    rng = np.random.default_rng(1)
    some = rng.normal(size=(30, 5)).astype(np.float32).tolist()
    all_ = some + [some[0]] * 40
    out = cases.collect(whitening.whiten(vectors(spark, [(i, v, 0) for i, v in enumerate(all_)]), "vec_id", "embedding", 3))
    check(out, list(range(len(all_))), all_, 3)


def test_more_components_than_vectors(spark):
    some = [[1.0, 2.0, 3.0, 0.5], [0.0, 1.0, 5.0, 0.5], [2.0, 0.0, 1.0, 0.5]]
    out = cases.collect(whitening.whiten(vectors(spark, [(i, v, 0) for i, v in enumerate(some)]), "vec_id", "embedding"))
    check(out, [0, 1, 2], some)
    assert {r["component"] for r in out} == {1, 2}


def test_odd_and_empty_tables(spark):
    nan, inf = float("nan"), float("inf")
    fine = [[0.5, -1.0, 2.0], [1.5, 1.0, 2.5], [0.5, 3.0, 1.0], [0.25, 0.0, -2.0], [9.0, 1.0, 1.0]]
    odd = [None, [], [None, 1.0, 1.0], [nan, 1.0, 1.0], [inf, 0.0, 0.0], [1.0, -inf, 0.0], [1.0, 2.0], [1e20, 0.0, 0.0]]
    rows = [(i, v, 1) for i, v in enumerate(fine)] + [(None, fine[0], None), (3, fine[3], 1)] + [(100 + i, v, 2) for i, v in enumerate(odd)]
    df = vectors(spark, rows).withColumns({"x": F.lit("clash"), "component": F.lit(1), "n": F.lit(2)})
    out = cases.collect(whitening.whiten(df, "vec_id", "embedding"))
    assert Counter(r["vec_id"] for r in out) == Counter({0: 3, 1: 3, 2: 3, 3: 6, 4: 3, None: 3})
    assert {r["n"] for r in out} == {5} and out[0]["identity_error"] < 1e-12
    for bad in ([], [(1, None, 0)], [(1, [], 0)], [(1, [1.0, 2.0], 0)] * 3):
        assert whitening.whiten(vectors(spark, bad), "vec_id", "embedding").count() == 0


def test_huge_entries_stay_exact(spark):
    """Beyond 64 bits the sums and deviations are still exact."""
    some = [[float(2**k), float(3**i)] for i, k in enumerate((40, 45, 49, 12, 3))]
    out = cases.collect(whitening.whiten(vectors(spark, [(i, v, 0) for i, v in enumerate(some)]), "vec_id", "embedding"))
    x = [[int(v * 64) + 1_000_000 for v in np.float32(r).astype(float)] for r in some]
    total = [sum(c) for c in zip(*x)]
    assert {r["vec_id"]: int(r["deviation"]) for r in out} == {i: sum((5 * a - t) ** 2 for a, t in zip(r, total)) for i, r in enumerate(x)}
