"""Whitening of integer vectors by exact principal components (operator 12).

Entries become integers, ``floor(scale * c) + offset``, and the vectors to fit are each distinct one once. Their scatter matrix
``n * sum(x x') - S S'``, which is the covariance times ``n`` squared, is an integer matrix and is worked out exactly. So is its
characteristic polynomial: tasks reduce the matrix to Hessenberg form modulo one prime each, and the Chinese remainders of the
coefficients are the coefficients, since the primes' product exceeds a bound on them. All roots are real, which makes counts
of roots by sign variations exact; bisection isolates the largest ones and narrows them to ``ROOT_BITS`` bits. Inverse
iteration with decimals of that precision gives the null space of the matrix less each root, one task a root. Rows are projected
in doubles, from exactly centred entries.

Bounds: the driver and each task hold a few matrices of dimension by dimension and one number a prime and coefficient, whatever
the number of rows. Exact sums are of (pair of dimensions) keys, combined in each task. The work on the matrix grows with the fourth
power of the dimension or so and is meant for hundreds of dimensions.

Defined results: rows whose vector is null or empty, or holds null, non-finite or unrepresentable entries (beyond 62 bits when
scaled), are dropped; a null id is kept; repeated rows are whitened each for itself and fitted once; equal eigenvalues get any
orthonormal vectors of their space, the same for all rows; the sign of a component makes its largest entry positive; eigenvalues
of 0 (fewer distinct vectors than dimensions) have no component, so a table of one distinct vector has none; an empty table gives
an empty result. Vectors of different lengths are refused.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from steward.llm.columns import picked
from steward.session import stored

#: Bits to which roots are known, relative to the largest; close ones beyond that count as equal.
ROOT_BITS = 200
#: Digits of the inverse iteration: those of the roots and as many again for what cancels.
DIGITS = 130
#: Bits of a limb when entries are multiplied as doubles, and the rows for which sums of products stay exact.
LIMB, EXACT_ROWS = 20, 1 << 13
#: Sums are passed on as ``high * 2 ** WORD + low``.
WORD = 60


@dataclass(frozen=True)
class Whitening:
    """Integer sums of the fit list and its components: ``vectors`` (one a row, unit length) by falling ``values``, which are
    eigenvalues of the covariance; ``reference`` is subtracted from entries before anything is multiplied."""

    n: int
    reference: np.ndarray
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray


def integer_vectors(df: DataFrame, vec_id: str, vector: str, scale: float, offset: int) -> DataFrame:
    """``(vec_id, x)`` of the rows that take part; ``x`` are whole numbers."""
    rows = picked(df, vec_id=vec_id, v=vector).withColumn("v", F.transform("v", lambda c: c.cast("double") * F.lit(float(scale))))
    sound = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(2.0**62)))
    x = F.transform("v", lambda c: F.floor(c).cast("long") + F.lit(offset).cast("long"))
    return rows.filter((F.size("v") > 0) & sound).select(F.col("vec_id").cast("long"), x.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.values.to_numpy().reshape(len(column), -1) if len(column) else np.empty((0, 0), np.int64)


def exact_gram(y: np.ndarray) -> np.ndarray:
    """``y' y`` of long integers as Python integers: products of limbs are summed in doubles, which is exact for that many rows."""
    total = np.zeros((y.shape[1], y.shape[1]), dtype=object)
    for begin in range(0, len(y), EXACT_ROWS):
        rest, limbs = y[begin : begin + EXACT_ROWS], []
        while len(rest) and max(int(rest.max()), -int(rest.min())) >= 1 << LIMB:
            limbs.append((rest & ((1 << LIMB) - 1)).astype(np.float64))
            rest = rest >> LIMB
        limbs.append(rest.astype(np.float64))
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                total += (a.T @ b).astype(np.int64).astype(object) << (LIMB * (i + j))
    return total


def _words(values: list[int]) -> pa.RecordBatch:
    high = pa.array([Decimal(v >> WORD) for v in values], pa.decimal128(38, 0))
    low = pa.array([Decimal(v & ((1 << WORD) - 1)) for v in values], pa.decimal128(38, 0))
    return pa.record_batch([pa.array(range(len(values)), pa.int32()), high, low], ["at", "high", "low"])


def _exact_sums(fit: DataFrame, partial) -> list[int]:
    """Sums over all rows of what ``partial(x)`` gives for a block of them, a list of integers of one length."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = partial(_matrix(batch["x"]))
                total = part if total is None else total + part
        if total is not None:
            yield _words(total.tolist())

    parts = fit.select("x").mapInArrow(add, "at int, high decimal(38,0), low decimal(38,0)")
    sums = parts.groupBy("at").agg(*[F.sum(c).cast("decimal(38,0)").alias(c) for c in ("high", "low")])
    return [(int(r["high"]) << WORD) + int(r["low"]) for r in sorted(sums.collect(), key=lambda r: r["at"])]


def scatter(fit: DataFrame) -> tuple[int, np.ndarray, list[int], np.ndarray]:
    """``n``, a reference vector near the mean, the sums of ``x`` less it, and the scatter matrix, of ``fit(x)``; all exact."""
    shape = fit.agg(F.count("*").alias("n"), F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("most")).first()
    n = shape["n"]
    if n and shape["least"] != shape["most"]:
        raise ValueError(f"vectors of {shape['least']} to {shape['most']} entries")
    if not n:
        return 0, np.empty(0, np.int64), [], np.empty((0, 0), dtype=object)
    reference = np.array([s // n for s in _exact_sums(fit, lambda x: x.astype(object).sum(axis=0))], dtype=np.int64)
    d = len(reference)
    upper = np.triu_indices(d)

    def products(x: np.ndarray) -> np.ndarray:
        y = x - reference
        return np.concatenate([y.astype(object).sum(axis=0), exact_gram(y)[upper]])

    sums = _exact_sums(fit, products)
    s, gram = np.array(sums[:d], dtype=object), np.zeros((d, d), dtype=object)
    gram[upper] = sums[d:]
    gram = gram + np.triu(gram, 1).T
    return n, reference, sums[:d], n * gram - np.outer(s, s)


def is_prime(p: int) -> bool:
    """For odd ``p`` below 3.2 billion, of which these bases leave no composite."""
    odd, twos = p - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, p)
        if x not in (1, p - 1) and not any((x := x * x % p) == p - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_for(bits: int) -> list[int]:
    """The largest primes below 2 ** 31, enough for a product of more than ``bits`` bits."""
    out, p = [], (1 << 31) - 1
    while len(out) * 30 <= bits:
        if is_prime(p):
            out.append(p)
        p -= 2
    return out


def polynomial_modulo(matrix: list[list[int]], p: int) -> np.ndarray:
    """Coefficients modulo ``p``, from the constant up, of the characteristic polynomial: Hessenberg form by elimination with
    similar row and column operations, then the recurrence over its leading blocks."""
    h = np.array([[v % p for v in row] for row in matrix], dtype=np.int64)
    d = len(h)
    for m in range(1, d - 1):
        pivots = np.flatnonzero(h[m:, m - 1])
        if not len(pivots):
            continue
        i = m + int(pivots[0])
        if i != m:
            h[[m, i]] = h[[i, m]]
            h[:, [m, i]] = h[:, [i, m]]
        factor = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1 :] = (h[m + 1 :] - factor[:, None] * h[m] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1 :] * factor % p).sum(axis=1)) % p
    poly = np.zeros((d + 1, d + 1), dtype=np.int64)
    poly[0, 0] = 1
    for k in range(1, d + 1):
        poly[k, 1:] = poly[k - 1, :-1]
        weights, chain = np.zeros(k, dtype=np.int64), 1
        for i in range(k - 1, -1, -1):
            weights[i] = h[i, k - 1] * chain % p
            if i:
                chain = chain * int(h[i, i - 1]) % p
        poly[k] = (poly[k] - (weights[:, None] * poly[:k] % p).sum(axis=0)) % p
    return poly[d]


def characteristic_polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Coefficients, from the constant up, for a symmetric matrix without negative eigenvalues; primes are dealt to tasks."""
    d, trace = len(matrix), int(np.trace(matrix))
    mean = -(-trace // d)  # the sum of products of k eigenvalues is the largest where all are equal
    bound = max(math.comb(d, k) * mean**k for k in range(d + 1))
    primes, rows = primes_for(2 * bound.bit_length() + 2), matrix.tolist()

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ps = batch["p"].to_pylist()
            yield pa.record_batch([pa.array(ps), pa.array([polynomial_modulo(rows, p).tolist() for p in ps])], ["p", "c"])

    tasks = min(len(primes), 4 * spark.sparkContext.defaultParallelism)
    dealt = spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks)
    residues = dealt.mapInArrow(reduce, "p long, c array<long>").collect()
    product = math.prod(primes)
    total = [0] * (d + 1)
    for p, c in residues:
        others = product // p
        unit = others * pow(others % p, -1, p)
        total = [(t + unit * r) % product for t, r in zip(total, c, strict=True)]
    return [t - product if 2 * t > product else t for t in total]


def _scaled(poly: list[int], bits: int) -> list[int]:
    """The polynomial whose roots are those of ``poly`` times ``2 ** bits``."""
    d = len(poly) - 1
    return [c << (bits * (d - i)) for i, c in enumerate(poly)]


def roots_above(poly: list[int], a: int) -> int:
    """How many roots of ``poly``, all of which are real, exceed ``a``: the sign variations of the polynomial moved there."""
    c = poly[:]
    for i in range(len(c) - 1):
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += a * c[j + 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def largest_roots(poly: list[int], k: int, top: int) -> list[tuple[int, int, int]]:
    """``(root, bits, multiplicity)`` of the ``k`` largest positive roots (or those of the last one's multiplicity) by falling size:
    the root is ``root / 2 ** bits``, rounded up in its last bit. ``top`` is at least as large as all."""
    out: list[tuple[int, int, int]] = []
    bits = max(0, ROOT_BITS - top.bit_length())
    whole, fine = poly, _scaled(poly, bits)
    found = 0
    # (low, high], roots above each: intervals of whole numbers, then of numbers scaled by 2 ** bits.
    open_ = [(0, top, roots_above(whole, 0), 0, False)]
    while open_ and found < k:
        low, high, above_low, above_high, scaled = open_.pop()
        count = above_low - above_high
        if not count:
            continue
        if high - low == 1 or (count == 1 and not scaled):
            if scaled:
                out.append((high, bits, count))
                found += count
                continue
            low, high, scaled = low << bits, high << bits, True
        if count == 1:
            # One simple root in (low, high]: the sign to its right is that of the roots beyond.
            sign = 1 if above_high % 2 == 0 else -1
            while high - low > 1:
                mid = (low + high) // 2
                value = 0
                for c in reversed(fine):
                    value = value * mid + c
                if value * sign >= 0:
                    high = mid
                else:
                    low = mid
            out.append((high, bits, 1))
            found += 1
            continue
        if high - low == 1:
            out.append((high, bits, count))
            found += count
            continue
        mid = (low + high) // 2
        above = roots_above(fine if scaled else whole, mid)
        open_.append((low, mid, above_low, above, scaled))
        open_.append((mid, high, above, above_high, scaled))
    return out


def null_vectors(matrix: list[list[int]], root: int, bits: int, count: int) -> list[list[float]]:
    """Unit eigenvectors of a symmetric integer matrix for a root of that multiplicity, by inverse iteration in decimals."""
    d = len(matrix)
    with localcontext() as context:
        context.prec, context.Emin, context.Emax = DIGITS, -999_999, 999_999
        shift = Decimal(root) / Decimal(2) ** bits
        a = np.array([[Decimal(int(v)) for v in row] for row in matrix], dtype=object)
        size = sum(a[i, i] for i in range(d))
        tiny = size * Decimal(10) ** -DIGITS
        for i in range(d):
            a[i, i] -= shift
        order = np.arange(d)
        for k in range(d):
            best = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
            if best != k:
                a[[k, best]], order[[k, best]] = a[[best, k]], order[[best, k]]
            if abs(a[k, k]) < tiny:
                a[k, k] = tiny
            if k + 1 < d:
                a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
                a[k + 1 :, k + 1 :] = a[k + 1 :, k + 1 :] - np.outer(a[k + 1 :, k], a[k, k + 1 :])

        def solve(b):
            x = b[order].copy()
            for k in range(1, d):
                x[k] -= (a[k, :k] * x[:k]).sum()
            for k in range(d - 1, -1, -1):
                if k + 1 < d:
                    x[k] -= (a[k, k + 1 :] * x[k + 1 :]).sum()
                x[k] /= a[k, k]
            return x

        found: list[np.ndarray] = []
        rng = np.random.default_rng(12)
        for _ in range(count):
            x = np.array([Decimal(int(v)) for v in rng.integers(1, 1 << 30, d)], dtype=object)
            for _ in range(4):
                for v in found:
                    x = x - v * (v * x).sum()
                x = x / (x * x).sum().sqrt()
                x = solve(x)
            for v in found:
                x = x - v * (v * x).sum()
            found.append(x / (x * x).sum().sqrt())
    vectors = np.array(found, dtype=np.float64)
    lead = vectors[np.arange(count), np.abs(vectors).argmax(axis=1)]
    return (vectors * np.sign(lead)[:, None]).tolist()


def fit_whitening(fit: DataFrame, components: int) -> Whitening:
    """The whitening of ``fit(x)``, distinct vectors of whole numbers."""
    spark = fit.sparkSession
    n, reference, sums, matrix = scatter(fit)
    d = len(reference)
    trace = int(np.trace(matrix)) if d else 0
    if not trace:
        return Whitening(n, reference, sums, np.empty(0), np.empty((0, d)), np.empty(0))
    common = math.gcd(*[int(v) for v in matrix.ravel()])
    reduced = matrix // common
    top = int(np.trace(reduced))
    roots = largest_roots(characteristic_polynomial(spark, reduced), min(components, d), top)
    rows = reduced.tolist()

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, root, bits, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                vectors = null_vectors(rows, int(root), bits, count)
                yield pa.record_batch([pa.array([at] * count, pa.int32()), pa.array(vectors)], ["at", "v"])

    dealt = spark.createDataFrame([(i, str(r), b, m) for i, (r, b, m) in enumerate(roots)], "at int, root string, bits int, count int")
    solved = sorted(dealt.repartition(len(roots)).mapInArrow(solve, "at int, v array<double>").collect(), key=lambda r: r["at"])
    solved = solved[:components]
    values, shares = [], []
    with localcontext() as context:
        context.prec = DIGITS
        for r in solved:
            root, bits, _ = roots[r["at"]]
            e = Decimal(root) / Decimal(2) ** bits
            values.append(float(e * common / Decimal(n) ** 2))
            shares.append(float(e / top))
    return Whitening(n, reference, sums, np.array(values), np.array([r["v"] for r in solved]), np.array(shares))


def projected(x: np.ndarray, w: Whitening) -> tuple[np.ndarray, list[int]]:
    """Whitened coordinates of integer vectors, and the exact sum of squares of ``n * x - S``."""
    y = x - w.reference
    largest = w.n * max(int(y.max()), -int(y.min())) + max(map(abs, w.sums))
    if largest >= 1 << 62:
        y = y.astype(object)
    centred = w.n * y - np.array(w.sums, dtype=y.dtype)
    if largest * largest * len(w.sums) < 1 << 62:
        squares = (centred * centred).sum(axis=1).tolist()
    else:
        wide = centred.astype(object)
        squares = (wide * wide).sum(axis=1).tolist()
    return centred.astype(np.float64) @ w.vectors.T / (w.n * np.sqrt(w.values)), squares


def identity_error(fit: DataFrame, w: Whitening) -> float:
    """The largest absolute entry of the whitened fit list's covariance less the identity."""
    k = len(w.values)
    if not k:
        return 0.0

    def total(values) -> np.ndarray:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = None
            for batch in batches:
                if batch.num_rows:
                    part = values(projected(_matrix(batch["x"]), w)[0]).ravel()
                    out = part if out is None else out + part
            if out is not None:
                yield pa.record_batch([pa.array(range(len(out)), pa.int32()), pa.array(out)], ["at", "s"])

        sums = fit.select("x").mapInArrow(add, "at int, s double").groupBy("at").agg(F.sum("s").alias("s")).collect()
        return np.array([r["s"] for r in sorted(sums, key=lambda r: r["at"])]) / w.n

    mean = total(lambda z: z.sum(axis=0))
    covariance = total(lambda z: (z - mean).T @ (z - mean)).reshape(k, k)
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = 16, scale: float = 64.0,
           offset: int = 1_000_000) -> tuple[DataFrame, Whitening, float]:
    """One row per row that takes part: ``vec_id``, ``deviation`` (the sum of squares of ``n * x - S``, exact, as text, for it has no
    bound) and ``whitened``, at most ``components`` coordinates; with the fitted whitening and its identity error."""
    if components < 1:
        raise ValueError("at least one component")
    rows = integer_vectors(df, vec_id, vector, scale, offset)
    fit = stored(rows.select("x").distinct(), "whitening-fit")
    w = fit_whitening(fit, components)
    schema = "vec_id long, deviation string, whitened array<double>"
    if not w.n:
        return df.sparkSession.createDataFrame([], schema), w, 0.0

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                z, squares = projected(_matrix(batch["x"]), w)
                columns = [batch["vec_id"], pa.array(map(str, squares), pa.string()), pa.array(list(z), pa.list_(pa.float64()))]
                yield pa.record_batch(columns, ["vec_id", "deviation", "whitened"])

    return rows.mapInArrow(project, schema), w, identity_error(fit, w)
