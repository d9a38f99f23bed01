"""Whitening of vectors by the exact characteristic polynomial of their scatter.

Entries become whole numbers, so the scatter ``n * sum(x x') - S S'`` over the distinct vectors is an exact integer matrix,
summed in the tasks and by key. Its characteristic polynomial is found modulo many primes, each by reduction to Hessenberg
form (the primes are rows of a Spark job), and put together by the Chinese remainder theorem. All roots of a symmetric
matrix' polynomial are real, so the sign changes of its coefficients after a Taylor shift by ``a`` count exactly the roots
above ``a``: bisection isolates the largest roots, and the sign of the polynomial refines them, all in whole numbers, to
about ``PRECISION`` bits. A component spans the null space of ``scatter - root``; inverse iteration in fixed-point numbers
finds it (the roots are rows of a Spark job). Only then do doubles appear, so neither near nor tiny eigenvalues spoil the
components.

What the driver holds are the scatter and the polynomial, whose size depends on the number of dimensions alone.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.workspace import store

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
#: Bits to which a root is found, relative to the trace, and bits behind the point while its null space is solved.
PRECISION, POINT = 120, 320
#: Entries as large as this have no code.
LARGEST = 2.0**50
PRIMES_A_TASK = 16
_LIMB = 1 << 60


# ---- codes -------------------------------------------------------------------------------------------------------


def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST)


def codes(vector: str) -> Column:
    """``floor(SCALE * c) + SHIFT`` for each entry; null if the vector or an entry is null or not finite."""
    c = F.col(vector).cast("array<double>")
    whole = F.transform(c, lambda x: F.floor(x * SCALE).cast("long") + SHIFT)
    return F.when(F.forall(c, _finite), whole)


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    """Codes of a batch less SHIFT."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d).astype(np.int64) - SHIFT


# ---- scatter -----------------------------------------------------------------------------------------------------

_SUMS = "k int, high decimal(38,0), low decimal(38,0)"


def _exact_gram(u: np.ndarray) -> np.ndarray:
    """``u' u`` as Python integers."""
    most = int(np.abs(u).max(initial=0))
    if len(u) * most * most < 1 << 53:  # sums of products that doubles hold exactly
        return (u.astype(np.float64).T @ u.astype(np.float64)).astype(np.int64).astype(object)
    wide = u.astype(object)
    return wide.T @ wide


def _part_sums(d: int):
    upper = np.triu_indices(d)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total, gram = 0, np.zeros(d, dtype=object), np.zeros(len(upper[0]), dtype=object)
        for batch in batches:
            if batch.num_rows:
                u = _matrix(batch.column(0), d)
                rows += len(u)
                total = total + u.astype(object).sum(axis=0)
                gram = gram + _exact_gram(u)[upper]
        if rows:
            values = [rows, *total, *gram]
            kind = pa.decimal128(38, 0)
            high, low = [int(v) // _LIMB for v in values], [int(v) % _LIMB for v in values]
            yield pa.record_batch({"k": pa.array(range(len(values)), pa.int32()), "high": pa.array(high, kind), "low": pa.array(low, kind)})

    return sums


def scatter(fit: DataFrame, d: int) -> tuple[int, list[int], list[list[int]]]:
    """Rows, sums less SHIFT, and ``n * sum(u u') - S S'`` of a table of codes (``x``)."""
    parts = fit.select("x").mapInArrow(_part_sums(d), _SUMS).groupBy("k").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    got = {r.k: int(r.high) * _LIMB + int(r.low) for r in parts.collect()}  # d * (d + 3) / 2 + 1 rows
    n, total = got.get(0, 0), [got.get(1 + i, 0) for i in range(d)]
    out = [[0] * d for _ in range(d)]
    for k, (i, j) in enumerate(zip(*(x.tolist() for x in np.triu_indices(d)))):
        out[i][j] = out[j][i] = n * got.get(1 + d + k, 0) - total[i] * total[j]
    return n, total, out


# ---- characteristic polynomial -----------------------------------------------------------------------------------


def _is_prime(n: int) -> bool:
    """For odd n below 3.2e9 (Miller and Rabin with bases 2, 3, 5, 7)."""
    s = (n - 1 & 1 - n).bit_length() - 1
    for a in (2, 3, 5, 7):
        x = pow(a, n - 1 >> s, n)
        if x != 1 and all(pow(x, 1 << k, n) != n - 1 for k in range(s)):
            return False
    return True


def primes_above(bound: int) -> list[int]:
    """The largest primes below 2 ** 31, until their product exceeds ``bound``."""
    out, product, at = [], 1, (1 << 31) - 1
    while product <= bound:
        if _is_prime(at):
            out.append(at)
            product *= at
        at -= 2
    return out


def polynomial_mod(m: np.ndarray, p: int) -> np.ndarray:
    """Coefficients, constant first, of the characteristic polynomial of a matrix modulo a prime below 2 ** 31."""
    h, d = m.copy(), len(m)
    for j in range(d - 2):
        pivots = np.flatnonzero(h[j + 1 :, j])
        if not len(pivots):
            continue
        i = j + 1 + int(pivots[0])
        if i != j + 1:
            h[[i, j + 1]] = h[[j + 1, i]]
            h[:, [i, j + 1]] = h[:, [j + 1, i]]
        f = h[j + 2 :, j] * pow(int(h[j + 1, j]), -1, p) % p
        h[j + 2 :] = (h[j + 2 :] - f[:, None] * h[j + 1] % p) % p
        h[:, j + 1] = (h[:, j + 1] + (h[:, j + 2 :] * f % p).sum(axis=1)) % p
    polys = np.zeros((d + 1, d + 1), dtype=np.int64)  # of the leading blocks
    polys[0, 0] = 1
    for k in range(d):
        out = np.zeros(d + 1, dtype=np.int64)
        out[1:] = polys[k, :-1]
        weight, below = np.zeros(k + 1, dtype=np.int64), 1
        for i in range(k, -1, -1):
            weight[i] = int(h[i, k]) * below % p
            below = below * int(h[i, i - 1]) % p if i else 0
        polys[k + 1] = (out - (weight[:, None] * polys[: k + 1] % p).sum(axis=0)) % p
    return polys[d]


def characteristic_polynomial(spark: SparkSession, m: list[list[int]]) -> list[int]:
    """Coefficients, constant first, of a positive semidefinite integer matrix; the primes are dealt to tasks."""
    d = len(m)
    trace = sum(m[i][i] for i in range(d))
    # the k-th coefficient is at most binomial(d, k) * (trace / d) ** k, as no eigenvalue is negative
    bound = max(math.comb(d, k) * -(-(trace**k) // d**k) for k in range(d + 1))
    primes = primes_above(4 * bound)

    def residues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = np.array(m, dtype=object)
        for batch in batches:
            of = batch.column(0).to_pylist()
            rows = [polynomial_mod((wide % p).astype(np.int64), p).tolist() for p in of]
            yield pa.record_batch({"p": pa.array(of, pa.int64()), "c": pa.array(rows, pa.list_(pa.int64()))})

    tasks = -(-len(primes) // PRIMES_A_TASK)
    rows = spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks).mapInArrow(residues, "p long, c array<long>").collect()
    value, modulus = [0] * (d + 1), 1
    for row in sorted(rows):
        inverse = pow(modulus, -1, row.p)
        value = [v + modulus * ((c - v) * inverse % row.p) for v, c in zip(value, row.c)]
        modulus *= row.p
    return [v - modulus if 2 * v > modulus else v for v in value]


# ---- roots -------------------------------------------------------------------------------------------------------


def _scaled(poly: list[int], bits: int) -> list[int]:
    """The polynomial whose roots are those of ``poly`` times 2 ** bits."""
    d = len(poly) - 1
    return [c << bits * (d - k) for k, c in enumerate(poly)]


def roots_above(poly: list[int], a: int) -> int:
    """Roots above a whole number, with multiplicity, of a polynomial all of whose roots are real."""
    c = list(poly)
    for k in range(len(c) - 1):
        for i in range(len(c) - 2, k - 1, -1):
            c[i] += a * c[i + 1]
    signs = [x > 0 for x in c if x]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def _sign(poly: list[int], a: int) -> int:
    out = 0
    for c in reversed(poly):
        out = out * a + c
    return (out > 0) - (out < 0)


def largest_roots(poly: list[int], trace: int, most: int) -> list[tuple[int, int, int]]:
    """The largest positive roots in falling order as (numerator, bits, multiplicity): the root is numerator / 2 ** bits.

    ``poly`` has real roots only, none negative. Roots that agree to ``PRECISION`` bits of the trace are one.
    """
    positive = roots_above(poly, 0)
    most = min(most, positive)
    width = trace.bit_length()
    finest = max(0, PRECISION - width)
    out, found = [], 0
    # intervals (low, high] in units of 2 ** -bits with the numbers of roots above both ends, the highest last
    todo = [(0, 1 << width, 0, positive, 0)]
    while found < most:
        low, high, bits, above_low, above_high = todo.pop()
        inside = above_low - above_high
        if not inside:
            continue
        if inside == 1 or high - low == 1 and bits == finest:
            if inside == 1:
                low, high, bits = _refined(poly, low, high, bits, finest)
            # half a unit below the upper end, or the end itself if that is the root
            exact = _sign(_scaled(poly, bits), high) == 0
            out.append((high if exact else 2 * high - 1, bits if exact else bits + 1, inside))
            found += inside
            continue
        if high - low == 1:
            step = min(8, finest - bits)
            low, high, bits = low << step, high << step, bits + step
        middle = (low + high) // 2
        above = roots_above(_scaled(poly, bits), middle)
        todo += [(low, middle, bits, above_low, above), (middle, high, bits, above, above_high)]
    return out


def _refined(poly: list[int], low: int, high: int, bits: int, finest: int) -> tuple[int, int, int]:
    """The interval (low, high] of a simple root, narrowed to one unit of 2 ** -finest, or to the root itself."""
    step = finest - bits
    low, high, bits, scaled = low << step, high << step, finest, _scaled(poly, finest)
    end = _sign(scaled, high)
    while end and high - low > 1:
        middle = (low + high) // 2
        sign = _sign(scaled, middle)
        if sign == 0:
            return middle, middle, bits
        # above the root the sign is that of the upper end
        low, high = (low, middle) if sign == end else (middle, high)
    return low, high, bits


# ---- components --------------------------------------------------------------------------------------------------


def null_space(m: list[list[int]], numerator: int, bits: int, size: int) -> list[list[float]]:
    """``size`` unit vectors, at right angles, that span the null space of ``m - numerator / 2 ** bits``.

    Elimination with row pivots in fixed-point numbers, then inverse iteration; a pivot that vanishes becomes one unit in the
    last place.
    """
    d = len(m)
    scale = max(1, sum(m[i][i] for i in range(d)))
    a = np.array([[((v << bits) - (numerator if i == j else 0) << POINT) // (scale << bits) for j, v in enumerate(r)] for i, r in enumerate(m)], dtype=object)
    order, factors = [], []
    for j in range(d):
        i = j + int(np.argmax(np.abs(a[j:, j])))
        order.append(i)
        if i != j:
            a[[i, j]] = a[[j, i]]
        if a[j, j] == 0:
            a[j, j] = 1
        f = (a[j + 1 :, j] << POINT) // a[j, j]
        factors.append(f)
        if len(f):
            a[j + 1 :, j + 1 :] -= (f[:, None] * a[j, j + 1 :]) >> POINT

    def solve(b: np.ndarray) -> np.ndarray:
        b = b.copy()
        for j in range(d):
            if order[j] != j:
                b[[order[j], j]] = b[[j, order[j]]]
            b[j + 1 :] -= (factors[j] * b[j]) >> POINT
        for j in range(d - 1, -1, -1):
            b[j] = (b[j] << POINT) // a[j, j]
            b[:j] -= (a[:j, j] * b[j]) >> POINT
        return b

    def unit(v: np.ndarray) -> np.ndarray:
        length = math.isqrt(int((v * v).sum()))
        return (v << POINT) // max(length, 1)

    rng, found = random.Random(11), []
    for _ in range(size):
        v = unit(np.array([rng.randrange(-(1 << POINT), 1 << POINT) for _ in range(d)], dtype=object))
        for _ in range(3):
            v = unit(solve(v))
            for _ in range(2):
                for w in found:
                    v = unit(v - ((w * (int((v * w).sum()) >> POINT)) >> POINT))
        found.append(v)
    out = []
    for v in found:
        x = [int(c) / (1 << POINT) for c in v]
        out.append([-c for c in x] if x[int(np.argmax(np.abs(x)))] < 0 else x)  # one sign: the largest entry is positive
    return out


def components(spark: SparkSession, m: list[list[int]], most: int = COMPONENTS) -> tuple[list[Fraction], list[list[float]]]:
    """The largest positive eigenvalues of a positive semidefinite integer matrix in falling order, and unit eigenvectors."""
    trace = sum(m[i][i] for i in range(len(m)))
    if not trace:
        return [], []
    roots = largest_roots(characteristic_polynomial(spark, m), trace, most)

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(r["i"], null_space(m, int(r["numerator"]), r["bits"], r["size"])) for r in batch.to_pylist()]
            yield pa.record_batch({"i": pa.array([i for i, _ in rows], pa.int32()), "v": pa.array([v for _, v in rows], pa.list_(pa.list_(pa.float64())))})

    asked = spark.createDataFrame([(i, str(a), b, k) for i, (a, b, k) in enumerate(roots)], "i int, numerator string, bits int, size int")
    got = asked.repartition(len(roots)).mapInArrow(spans, "i int, v array<array<double>>").collect()
    spanned = [v for row in sorted(got, key=lambda r: r.i) for v in row.v]
    values = [Fraction(a, 1 << b) for a, b, k in roots for _ in range(k)]
    return values[:most], spanned[:most]


# ---- whitening ---------------------------------------------------------------------------------------------------

OUTPUT = ["component int", "n long", "deviation decimal(38,0)", "whitened double", "explained double", "identity_error double"]


def _projection(total: list[int], n: int, axes: np.ndarray, spread: np.ndarray):
    """Function from codes less SHIFT to (deviations, whitened values)."""
    sums = np.array(total, dtype=object)
    bound = max(map(abs, total), default=0)

    def project(u: np.ndarray) -> tuple[list[int], np.ndarray]:
        most = int(np.abs(u).max(initial=0))
        if u.shape[1] * (n * most + bound) ** 2 < 1 << 62:
            off = n * u - sums.astype(np.int64)
            away = (off * off).sum(axis=1).tolist()
        else:
            off = n * u.astype(object) - sums
            away = [int(v) for v in (off * off).sum(axis=1)]
        return away, (off.astype(np.float64) / n) @ axes / spread

    return project


def _identity_error(fit: DataFrame, d: int, n: int, k: int, project) -> float:
    """Largest entry of the whitened fit list's covariance less the identity."""
    upper = np.triu_indices(k)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k + len(upper[0]))
        for batch in batches:
            if batch.num_rows:
                w = project(_matrix(batch.column(0), d))[1]
                total += np.concatenate([w.sum(axis=0), (w.T @ w)[upper]])
        yield pa.record_batch({"k": pa.array(range(len(total)), pa.int32()), "v": pa.array(total)})

    got = {r.k: r.v / n for r in fit.select("x").mapInArrow(sums, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()}
    mean = np.array([got[i] for i in range(k)])  # of values that are centred already: what rounding leaves
    cov = np.array([got[k + i] for i in range(len(upper[0]))]) - (mean[:, None] * mean)[upper]
    return float(np.abs(cov - (upper[0] == upper[1])).max())


def whiten(df: DataFrame, key: str, vector: str, most: int = COMPONENTS) -> DataFrame:
    """One row for each row of ``df`` with a usable vector and each component: ``key``, component (from 1), n (distinct
    vectors), deviation (exact; null beyond 38 digits), whitened, explained, identity_error.

    Vectors that are null, hold null or non-finite entries, or entries of 2 ** 50 and more, go; so do those of another length
    than most have (of equally frequent lengths the greatest counts). Repeated rows have rows of their own, but
    count once in the fit. Components of eigenvalue zero, on which nothing varies, don't exist: fewer distinct vectors than
    dimensions give fewer components, one distinct vector or an empty table gives no row. Other columns are left out. Only
    the key and the codes are read; the distinct vectors are written once.
    """
    spark = df.sparkSession
    coded = df.select(F.col(key), codes(vector).alias("x")).where("x IS NOT NULL")
    lengths = coded.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("rows"))
    usual = lengths.agg(F.max(F.struct("rows", "d")).alias("m")).first().m
    empty = spark.createDataFrame([], df.select(key).schema).select(key, *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in OUTPUT])
    if usual is None or not usual.d:
        return empty
    d = usual.d
    coded = coded.where(F.size("x") == d)
    fit = store(coded.select("x").distinct(), "whitening-fit")
    n, total, m = scatter(fit, d)
    values, axes = components(spark, m, most)
    if not values:
        return empty
    k, trace = len(values), sum(m[i][i] for i in range(d))
    # the covariance is the scatter over n squared
    spread = np.array([math.sqrt(v / (n * n)) for v in values])
    project = _projection(total, n, np.array(axes).T, spread)
    explained = np.array([float(v / trace) for v in values])
    error = _identity_error(fit, d, n, k, project)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                away, white = project(_matrix(batch.column(1), d))
                count = len(away)
                again = pa.array(np.repeat(np.arange(count), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(again), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                        pa.array(np.full(count * k, n, dtype=np.int64)), pa.array([v if v < 10**38 else None for v in away], pa.decimal128(38, 0)).take(again),
                        pa.array(white.ravel()), pa.array(np.tile(explained, count)), pa.array(np.full(count * k, error)),
                    ],
                    names=names,
                )

    names = [key, *[c.split()[0] for c in OUTPUT]]
    kind = df.select(key).schema[0].dataType.simpleString()
    return coded.mapInArrow(rows, ", ".join([f"`{key}` {kind}", *OUTPUT]))
