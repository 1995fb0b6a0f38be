import math
from fractions import Fraction

import numpy as np
import pytest

from steward.llm import whitening
from steward.llm.bindings import QUERIES
from steward.llm.whitening import (
    characteristic_polynomial, exact_gram, largest_roots, null_vectors, polynomial_modulo, primes_for, roots_above, whiten,
)

SCHEMA = "vec_id long, embedding array<double>, label int, n long, x string, deviation int, whitened int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "x", 3, 4) for i, v in rows], SCHEMA)


def brute_polynomial(matrix):
    """Coefficients by the traces of powers, in fractions."""
    d = len(matrix)
    m, c = np.array(matrix, dtype=object), [Fraction(1)]
    power = np.eye(d, dtype=object) * 0
    for k in range(1, d + 1):
        power = m.dot(power + np.eye(d, dtype=object) * c[-1])
        c.append(-Fraction(sum(power[i, i] for i in range(d))) / k)
    return [int(v) for v in reversed(c)]


def symmetric(seed, d, size=50, rank=None):
    y = np.random.default_rng(seed).integers(-size, size, (rank or d, d)).astype(object)
    return y.T.dot(y)


@pytest.mark.parametrize("d,rank", [(1, 1), (2, 2), (5, 5), (9, 4), (12, 12)])
def test_polynomial(spark, d, rank):
    m = symmetric(d, d, rank=rank)
    want = brute_polynomial(m)
    assert characteristic_polynomial(spark, m) == want
    p = primes_for(1)[0]
    assert polynomial_modulo(m.tolist(), p).tolist() == [c % p for c in want]
    sparse = np.diag([3, 0, 0, 5, 5]).astype(object)
    assert characteristic_polynomial(spark, sparse) == brute_polynomial(sparse)


def test_primes():
    found = primes_for(300)
    assert len(set(found)) == len(found) and math.prod(found).bit_length() > 300
    assert all(all(p % q for q in range(2, math.isqrt(p) + 1)) for p in found[:3])


def times(*roots):
    poly = [1]
    for r in roots:
        poly = [a - r * b for a, b in zip([0, *poly], [*poly, 0], strict=True)]
    return poly


def test_roots_with_multiplicity():
    poly = times(9, 9, 9, 4, 1, 0, 0)
    assert [roots_above(poly, a) for a in (-1, 0, 1, 3, 4, 8, 9)] == [7, 5, 4, 4, 3, 3, 0]
    found = largest_roots(poly, 5, 23)
    assert [(r >> b, m) for r, b, m in found] == [(9, 3), (4, 1), (1, 1)]
    close = times(10**30 + 1, 10**30, 10**30 - 7)
    assert [r >> b for r, b, _ in largest_roots(close, 3, 3 * 10**30)] == [10**30 + 1, 10**30, 10**30 - 7]


def test_null_vectors():
    m = symmetric(3, 8)
    for r, b, count in largest_roots(brute_polynomial(m), 8, int(np.trace(m))):
        (v,) = null_vectors(m.tolist(), r, b, count)
        e = r / 2**b
        assert np.allclose(m.astype(float) @ v, e * np.array(v), atol=1e-9 * e + 1e-6) and math.isclose(np.dot(v, v), 1)
    pair = np.array(null_vectors(np.diag([4, 4, 1]).tolist(), 4, 0, 2))
    assert np.allclose(pair @ pair.T, np.eye(2)) and np.allclose(pair[:, 2], 0)


def test_exact_gram():
    rng = np.random.default_rng(1)
    for size in (60, 1 << 19, 1 << 45, 1 << 61):
        y = rng.integers(-size, size, (300, 4))
        assert (exact_gram(y) == y.astype(object).T.dot(y.astype(object))).all()


def check(rows, got, fitted, error, components, scale=64, offset=1_000_000):
    kept = [(i, [math.floor(scale * c) + offset for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = [list(v) for v in {tuple(x) for _, x in kept}]
    n, d = len(fit), len(fit[0])
    s = [sum(x[k] for x in fit) for k in range(d)]
    assert fitted.n == n
    want = sorted((i is not None, i, str(sum((n * a - b) ** 2 for a, b in zip(x, s)))) for i, x in kept)
    assert sorted((r["vec_id"] is not None, r["vec_id"], r["deviation"]) for r in got) == want
    centred = np.array([[float(Fraction(n * a - b, n)) for a, b in zip(x, s)] for x in fit])
    values = np.linalg.eigvalsh(centred.T @ centred / n)[::-1]
    k = min(components, sum(values > 1e-9 * values[0]))
    assert np.allclose(fitted.values, values[:k], rtol=1e-9)
    assert np.allclose(fitted.explained, values[:k] / values.sum(), rtol=1e-9)
    assert error < 1e-9
    white = np.array([r["whitened"] for r in got])
    assert white.shape == (len(kept), k)
    by_x = {tuple(x): np.array(r["whitened"]) for (_, x), r in zip(sorted(kept, key=lambda p: (p[0] is not None, p[0])), sorted(got, key=lambda r: (r["vec_id"] is not None, r["vec_id"])))}
    w = np.array(list(by_x.values()))
    assert len(w) == n and np.allclose(w.T @ w / n - np.outer(w.mean(0), w.mean(0)), np.eye(k), atol=1e-9)


def odd_rows(d=6, n=60):
    rng = np.random.default_rng(7)
    base = (rng.normal(size=(n, d)) * np.arange(1, d + 1)).tolist()
    rows = [(i, v) for i, v in enumerate(base)] + [(n + i, base[0]) for i in range(30)]
    rows += [(200, None), (201, []), (202, [None] + [1.0] * (d - 1)), (203, [math.nan] * d), (204, [math.inf] * d), (205, [1e300] * d)]
    return rows + [(None, [0.25] * d)]


@pytest.mark.parametrize("components", [3, 16])
def test_equals_floating_point(spark, components):
    rows = odd_rows()
    out, fitted, error = whiten(vectors(spark, rows), components=components)
    check([r for r in rows if r[0] != 205], out.collect(), fitted, error, components)


def test_few_vectors_and_none(spark):
    few = [(0, [1.0, 2.0, 3.0]), (1, [0.5, -2.0, 3.0]), (2, [0.5, 9.0, 3.0])]
    out, fitted, error = whiten(vectors(spark, few))
    check(few, out.collect(), fitted, error, 16)
    out, fitted, error = whiten(vectors(spark, [(0, [1.0, 2.0]), (1, [1.0, 2.0])]))
    assert [(r["whitened"], r["deviation"]) for r in out.collect()] == [([], "0")] * 2 and error == 0
    assert whiten(vectors(spark, []))[0].count() == 0
    assert whiten(vectors(spark, [(1, None), (2, [])]))[0].count() == 0
    with pytest.raises(ValueError):
        whiten(vectors(spark, [(0, [1.0]), (1, [1.0, 2.0])]))


def test_large_numbers(spark):
    rows = [(i, [1e12 * math.sin(i), 3e11 * math.cos(3 * i), 1e14 + 1e11 * math.sin(i * i)]) for i in range(40)]
    out, fitted, error = whiten(vectors(spark, rows))
    check(rows, out.collect(), fitted, error, 16)


def test_sizes_far_apart(spark):
    """Eigenvalues 22 decimal digits apart, where doubles would lose the smaller ones."""
    rows = [(i, [1e12 * math.sin(i), 3.0 * i, 1e6 + i * i]) for i in range(40)]
    out, fitted, error = whiten(vectors(spark, rows))
    assert len(fitted.values) == 3 and error < 1e-9 and fitted.values[0] / fitted.values[2] > 1e21


def test_query(spark, tmp_path):
    rows = [(i, v) for i, v in odd_rows(20, 100) if i != 205]
    vectors(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = QUERIES["op12_whitening"](spark, str(tmp_path))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    table = got.collect()
    assert len(table) == 131 * 16 and {r["n"] for r in table} == {101} and len({r["identity_error"] for r in table}) == 1
    shares = sorted({(r["component"], r["explained"]) for r in table})
    assert [c for c, _ in shares] == list(range(1, 17)) and [s for _, s in shares] == sorted((s for _, s in shares), reverse=True)
    assert whitening.ROOT_BITS > 106
