"""Exact characteristic polynomials of integer matrices, their real roots, and null spaces.

Small, dense helpers: a matrix has the size of a vector's dimension, whatever the number of rows.
"""

from __future__ import annotations

from functools import reduce
from math import comb, isqrt

import numpy as np

#: Primes stay below this, so that a product of two residues fits into 64 bits.
LARGEST_PRIME = 1 << 31


def primes_below(limit: int, product: int) -> list[int]:
    """The largest odd primes below `limit` whose product exceeds `product`."""
    found, have, p = [], 1, limit + 1 - limit % 2
    while have <= product:
        p -= 2
        if _is_prime(p):
            found.append(p)
            have *= p
    return found


def _is_prime(p: int) -> bool:
    """Exact for odd numbers below 3,215,031,751 by the bases 2, 3, 5 and 7."""
    if p < 10 or p % 3 == 0 or p % 5 == 0 or p % 7 == 0:
        return p in (3, 5, 7)
    odd, twos = p - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, p)
        if x not in (1, p - 1) and not any((x := x * x % p) == p - 1 for _ in range(twos - 1)):
            return False
    return True


def coefficient_bound(matrix: list[list[int]]) -> int:
    """More than twice any coefficient of the polynomial of a symmetric matrix.

    A coefficient is a sum of principal minors, of which each is at most the product of
    its rows' lengths; the rows' lengths are rounded up.
    """
    rows = [isqrt(sum(x * x for x in row)) + 1 for row in matrix]
    d, longest = len(rows), max(rows, default=1)
    return 2 * max(comb(d, k) * longest**k for k in range(d + 1)) + 1


def polynomials_mod(residues: np.ndarray, primes: np.ndarray) -> np.ndarray:
    """det(x I - A) modulo each prime, lowest coefficient first, one row a prime.

    `residues` holds A modulo each prime. All primes are reduced to Hessenberg form side
    by side; a prime whose pivot is zero swaps rows and columns of its own.
    """
    k, d, _ = residues.shape
    p = primes.astype(np.int64)
    a = residues.astype(np.int64).copy()
    each = np.arange(k)
    for m in range(1, d - 1):
        pivot = m + (a[:, m:, m - 1] != 0).argmax(axis=1)
        rows = a[each, pivot].copy()
        a[each, pivot], a[:, m] = a[:, m].copy(), rows
        cols = a[each, :, pivot].copy()
        a[each, :, pivot], a[:, :, m] = a[:, :, m].copy(), cols
        factor = a[:, m + 1 :, m - 1] * inverses(a[:, m, m - 1], p)[:, None] % p[:, None]
        a[:, m + 1 :] = (a[:, m + 1 :] - factor[:, :, None] * a[:, m, None, :] % p[:, None, None]) % p[:, None, None]
        moved = (a[:, :, m + 1 :] * factor[:, None, :] % p[:, None, None]).sum(axis=2)
        a[:, :, m] = (a[:, :, m] + moved) % p[:, None]
    polys = np.zeros((d + 1, k, d + 1), np.int64)
    polys[0, :, 0] = 1
    for m in range(1, d + 1):
        new = np.zeros((k, d + 1), np.int64)
        new[:, 1:] = polys[m - 1, :, :-1]
        new = (new - a[:, m - 1, m - 1, None] * polys[m - 1]) % p[:, None]
        below = np.ones(k, np.int64)
        for i in range(1, m):
            below = below * a[:, m - i, m - i - 1] % p
            weight = below * a[:, m - i - 1, m - 1] % p
            new = (new - weight[:, None] * polys[m - i - 1]) % p[:, None]
        polys[m] = new
    return polys[d]


def inverses(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Inverses modulo primes; zero for zero."""
    return np.array([pow(int(v), -1, int(q)) if v else 0 for v, q in zip(x, p)], np.int64)


def combined(residues: np.ndarray, primes: list[int]) -> list[int]:
    """Signed integers from their residues, one row a prime, by Chinese remaindering."""
    product = reduce(lambda a, b: a * b, primes, 1)
    values = [0] * residues.shape[1]
    for row, p in zip(residues.tolist(), primes):
        rest = product // p
        weight = rest * pow(rest, -1, p)
        values = [v + weight * r for v, r in zip(values, row)]
    values = [v % product for v in values]
    return [v - product if v > product // 2 else v for v in values]


def roots_above(poly: list[int], at: int) -> int:
    """How many roots of a polynomial with real roots only are greater than `at`.

    Descartes' rule counts them exactly, each as often as it occurs: the sign changes
    of the polynomial shifted by `at`.
    """
    shifted = list(poly)
    d = len(shifted) - 1
    for i in range(d):
        for j in range(d - 1, i - 1, -1):
            shifted[j] += at * shifted[j + 1]
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _value(poly: list[int], at: int) -> int:
    return reduce(lambda v, c: v * at + c, reversed(poly), 0)


def largest_roots(poly: list[int], count: int, bits: int) -> list[tuple[int, int]]:
    """The `count` largest positive roots and their multiplicities, falling, in units of 2**-bits.

    `poly` has real roots only. Each root is known to one unit (rounded down); those that lie
    within one unit are one root that occurs several times. The last root is given
    with its whole multiplicity, so that multiplicities may add up to more than `count`.
    """
    d = len(poly) - 1
    scaled = [c << (bits * (d - i)) for i, c in enumerate(poly)]
    top = 1
    while roots_above(scaled, top):
        top <<= 1
    found: list[tuple[int, int]] = []
    waiting = [(0, top, roots_above(scaled, 0), 0)]  # roots above the ends of (low, high]
    while waiting and sum(m for _, m in found) < count:
        low, high, above_low, above_high = waiting.pop()
        if above_low == above_high:
            continue
        if above_low - above_high == 1:
            found.append((_bisected(scaled, low, high), 1))
        elif high - low == 1:
            found.append((low, above_low - above_high))
        else:
            middle = (low + high) // 2
            above = roots_above(scaled, middle)
            waiting += [(low, middle, above_low, above), (middle, high, above, above_high)]
    return found


def _bisected(poly: list[int], low: int, high: int) -> int:
    """The largest number below the only root in (low, high]; the root is simple."""
    right = _value(poly, high)
    if right == 0:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        value = _value(poly, middle)
        if value == 0:
            return middle
        if (value > 0) == (right > 0):
            high = middle
        else:
            low = middle
    return low


def null_space(matrix: list[list[int]], root: int, multiplicity: int, bits: int, extra: int = 128) -> np.ndarray:
    """Unit vectors that span the null space of A - root, by inverse iteration.

    `root` is in units of 2**-bits. Elimination works on integers with `extra` more bits,
    so that the vectors are right to double precision unless roots lie closer than 2**-bits.
    """
    d, scale = len(matrix), bits + extra
    a = np.array([[int(x) << scale for x in row] for row in matrix], object)
    for i in range(d):
        a[i, i] -= root << extra
    order, pivots = np.arange(d), []
    for m in range(d):
        best = m + max(range(d - m), key=lambda i: abs(a[m + i, m]))
        a[[m, best]], order[[m, best]] = a[[best, m]], order[[best, m]]
        pivots.append(a[m, m] or 1)  # a singular matrix: the smallest pivot
        if m + 1 < d:
            factor = (a[m + 1 :, m] << scale) // pivots[m]
            a[m + 1 :, m + 1 :] -= (factor[:, None] * a[m, m + 1 :][None, :]) >> scale
            a[m + 1 :, m] = factor
    rng = np.random.default_rng(multiplicity)
    vectors = np.array([[int(v) for v in rng.integers(-1000, 1001, d)] for _ in range(multiplicity)], object)
    vectors = _orthonormal(vectors << scale, scale)
    for _ in range(3):
        solved = []
        for v in vectors:
            x = v[order].copy()
            for m in range(d):
                x[m + 1 :] -= (a[m + 1 :, m] * x[m]) >> scale
            for m in range(d - 1, -1, -1):
                x[m] = ((x[m] - ((a[m, m + 1 :] * x[m + 1 :]).sum() >> scale)) << scale) // pivots[m]
            most = max(abs(t) for t in x) or 1
            solved.append(np.array([(t << scale) // most for t in x], object))
        vectors = _orthonormal(np.array(solved, object), scale)
    return np.array([[int(t) / (1 << scale) for t in v] for v in vectors], float)


def _orthonormal(vectors: np.ndarray, scale: int) -> np.ndarray:
    """Gram-Schmidt, twice, on fixed-point integers."""
    out: list[np.ndarray] = []
    for v in vectors:
        for _ in range(2):
            for u in out:
                v = v - ((u * ((u * v).sum() >> scale)) >> scale)
            length = isqrt(int((v * v).sum())) or 1
            v = np.array([(int(t) << scale) // length for t in v], object)
        out.append(v)
    return np.array(out, object)
