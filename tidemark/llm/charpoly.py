"""Exact spectrum of a positive semidefinite integer matrix.

Characteristic polynomial by Hessenberg reduction modulo primes and Chinese remaindering, real roots isolated by sign
changes and refined in integers, eigenvectors by inverse iteration in fixed-point integers. The primes and the vectors
are tasks of Spark; the matrix is as large as the dimension squared, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from math import comb, gcd, isqrt

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession

_GUARD = 64  # bits beyond the ones that tell neighbouring roots apart


def primes_below(limit: int, count: int) -> list[int]:
    """The ``count`` largest primes below ``limit`` (at most 2^31), by a sieve of the last stretch."""
    found: list[int] = []
    small = np.ones(int(limit**0.5) + 2, bool)
    small[:2] = False
    for i in range(2, int(len(small) ** 0.5) + 1):
        if small[i]:
            small[i * i :: i] = False
    high, divisors = limit, np.flatnonzero(small)
    while len(found) < count:
        low = max(2, high - 65_536)
        prime = np.ones(high - low, bool)
        for d in divisors:
            prime[max(d * d, -(-low // d) * d) - low :: d] = False
        found += [int(x) for x in (np.flatnonzero(prime) + low)[::-1]]
        high = low
    return found[:count]


def charpoly_mod(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(xI - matrix) modulo the prime ``p`` below 2^31, constant term first.

    ``matrix`` holds residues. Similarity transforms bring it to Hessenberg form, whose leading minors follow a recurrence.
    """
    h, size = matrix.astype(np.int64) % p, len(matrix)
    for col in range(size - 2):
        below = np.flatnonzero(h[col + 1 :, col])
        if not len(below):
            continue
        pivot = col + 1 + int(below[0])
        if pivot != col + 1:
            h[[pivot, col + 1]] = h[[col + 1, pivot]]
            h[:, [pivot, col + 1]] = h[:, [col + 1, pivot]]
        factors = h[col + 2 :, col] * pow(int(h[col + 1, col]), -1, p) % p
        h[col + 2 :] = (h[col + 2 :] - factors[:, None] * h[col + 1][None, :] % p) % p
        # Columns are added back: products are reduced before their sum, which stays below 2^63.
        h[:, col + 1] = (h[:, col + 1] + (h[:, col + 2 :] * factors[None, :] % p).sum(axis=1)) % p
    minors = np.zeros((size + 1, size + 1), np.int64)
    minors[0, 0] = 1
    for k in range(1, size + 1):
        minors[k, 1:] = minors[k - 1, :-1]
        minors[k] = (minors[k] - int(h[k - 1, k - 1]) * minors[k - 1]) % p
        path = 1
        for i in range(1, k):
            path = path * int(h[k - i, k - i - 1]) % p
            if not path:
                break
            minors[k] = (minors[k] - path * int(h[k - i - 1, k - 1]) % p * minors[k - i - 1]) % p
    return [int(x) for x in minors[size]]


def _residues(matrix: list[list[int]], p: int) -> np.ndarray:
    return np.array([[x % p for x in row] for row in matrix], np.int64)


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Integer coefficients of det(xI - matrix), constant term first, of a positive semidefinite integer ``matrix``.

    The elementary symmetric functions of non-negative roots are at most comb(d, k) * (trace / d)^k, which says how many
    primes determine them. Each prime is a row of a Spark job that returns one residue per coefficient.
    """
    size, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    most = max(comb(size, k) * (Fraction(trace, size) ** k) for k in range(size + 1))
    need = (2 * int(most) + 2).bit_length()
    primes = primes_below(1 << 31, need // 30 + 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [charpoly_mod(_residues(matrix, int(p)), int(p)) for p in batch["prime"]]
            yield pd.DataFrame({"prime": batch["prime"], "residues": rows})

    tasks = spark.createDataFrame([(p,) for p in primes], "prime long").repartition(min(len(primes), 64))
    rows = {r["prime"]: r["residues"] for r in tasks.mapInPandas(run, "prime long, residues array<long>").collect()}
    product = 1
    for p in primes:
        product *= p
    parts = [(p, product // p * pow(product // p, -1, p)) for p in primes]
    found = [sum(rows[p][k] * part for p, part in parts) % product for k in range(size + 1)]
    return [c - product if c > product // 2 else c for c in found]


@dataclass(frozen=True)
class Root:
    """A root in (low, high] / 2^bits, and how often it occurs."""

    low: int
    high: int
    bits: int
    times: int

    @property
    def value(self) -> Fraction:
        return Fraction(self.low + self.high, 2 << self.bits)


def _above(poly: list[int], at: int, bits: int) -> int:
    """Roots greater than ``at`` / 2^bits of a polynomial whose roots are all real, with multiplicity.

    By Descartes' rule, exact for such polynomials: the sign changes of the polynomial shifted by that number.
    """
    degree = len(poly) - 1
    shifted = [c << (bits * (degree - k)) for k, c in enumerate(poly)]
    for i in range(degree):
        for k in range(degree - 1, i - 1, -1):
            shifted[k] += at * shifted[k + 1]
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def _sign(poly: list[int], at: int, bits: int) -> int:
    """Sign of the polynomial at ``at`` / 2^bits."""
    value, degree = 0, len(poly) - 1
    for k in range(degree, -1, -1):
        value = value * at + (poly[k] << (bits * (degree - k)))
    return (value > 0) - (value < 0)


def _divided(a: list[Fraction], b: list[Fraction]) -> tuple[list[Fraction], list[Fraction]]:
    rest, quotient = list(a), [Fraction(0)] * max(1, len(a) - len(b) + 1)
    while len(rest) >= len(b) and any(rest):
        factor = rest[-1] / b[-1]
        shift = len(rest) - len(b)
        quotient[shift] = factor
        for i, c in enumerate(b):
            rest[shift + i] -= factor * c
        while rest and not rest[-1]:
            rest.pop()
    return quotient, rest


def _primitive(poly: list[Fraction]) -> list[Fraction]:
    scale = 1
    for c in poly:
        scale = scale * c.denominator // gcd(scale, c.denominator)
    whole = [int(c * scale) for c in poly]
    shared = gcd(*whole) * (1 if whole[-1] > 0 else -1)
    return [Fraction(c // shared) for c in whole]


def square_free(poly: list[int]) -> list[int]:
    """The polynomial with the same roots, each once."""
    first = _primitive([Fraction(c) for c in poly])
    slope = [k * c for k, c in enumerate(first)][1:]
    a, b = first, slope
    while b and any(b):
        a, b = b, _divided(a, b)[1]
        b = _primitive(b) if b else b
    return [int(c) for c in _primitive(_divided(first, a)[0])]


def _may_repeat(poly: list[int]) -> bool:
    """Whether the polynomial may have a multiple root. Never wrong when it says no: one prime without one proves it."""
    for p in primes_below(1 << 31, 6)[3:]:
        a, b = [c % p for c in poly], [k * c % p for k, c in enumerate(poly)][1:]
        while b and not b[-1]:
            b.pop()
        while b:
            inverse = pow(b[-1], -1, p)
            while len(a) >= len(b):
                factor, shift = a[-1] * inverse % p, len(a) - len(b)
                a = [(c - factor * b[i - shift]) % p if i >= shift else c for i, c in enumerate(a)]
                while a and not a[-1]:
                    a.pop()
            a, b = b, a
        if len(a) == 1:
            return False
    return True


def _isolated(poly: list[int], wanted: int, times) -> list[tuple[int, int, int, int]]:
    """(low, high, bits, times) of the largest roots, falling, until ``wanted`` are counted and one root more."""
    bound = 1 << (abs(poly[-2]) + 1).bit_length()  # the roots add up to less than that
    pending, alone, counted = [(0, bound, 0, 0, _above(poly, 0, 0))], [], 0
    while pending and counted <= wanted:
        low, high, bits, above, upto = pending.pop()
        if upto - above == 1:
            alone.append((low, high, bits, times(low, high, bits)))
            counted += alone[-1][-1]
            continue
        if high - low == 1:
            low, high, bits = low << 1, high << 1, bits + 1
        middle = (low + high) // 2
        between = _above(poly, middle, bits)
        pending += [(low, middle, bits, between, upto)] if between < upto else []
        pending += [(middle, high, bits, above, between)] if above < between else []
    return alone


def _narrowed(poly: list[int], root: Root, digits: int, bits: int) -> Root:
    """The root with ``digits`` significant bits at least, and ``bits`` behind the point."""
    low, high, fine = root.low, root.high, root.bits
    sign = _sign(poly, high, fine)
    if low == high or sign == 0:
        return Root(high, high, fine, root.times)
    while high - low > 1 or high.bit_length() < digits or fine < bits:
        if high - low == 1:
            low, high, fine = low << 1, high << 1, fine + 1
        middle = (low + high) // 2
        at = _sign(poly, middle, fine)
        if at == 0:
            return Root(middle, middle, fine, root.times)
        low, high = (low, middle) if at == sign else (middle, high)
    return Root(low, high, fine, root.times)


def largest_roots(poly: list[int], wanted: int) -> list[Root]:
    """The largest positive roots of a polynomial with real non-negative roots only, falling, until ``wanted`` are counted.

    Multiple roots are one ``Root``. Intervals are halved until each holds one root of the square-free part, and then
    until a root is known to ``_GUARD`` bits beyond its size and its distance to the next.
    """
    whole = list(poly)
    while len(whole) > 1 and not whole[0]:
        whole.pop(0)
    if len(whole) < 2:
        return []
    single = square_free(whole) if _may_repeat(whole) else whole

    def times(low: int, high: int, bits: int) -> int:
        return 1 if single is whole else _above(whole, low, bits) - _above(whole, high, bits)

    found = [_narrowed(single, Root(*place), 2 * _GUARD, 0) for place in _isolated(single, wanted, times)]
    while True:
        gaps = [abs(a.value - b.value) for a, b in zip(found, found[1:], strict=False)]
        near = [min(gaps[max(0, i - 1) : i + 1], default=Fraction(1)) for i in range(len(found))]
        need = [_GUARD + max(0, gap.denominator.bit_length() - gap.numerator.bit_length() + 1) if gap else 2 * r.bits + 1 for gap, r in zip(near, found, strict=True)]
        if all(r.bits >= bits or r.low == r.high for r, bits in zip(found, need, strict=True)):
            break
        found = [_narrowed(single, r, 2 * _GUARD, bits) for r, bits in zip(found, need, strict=True)]
    kept, counted = [], 0
    for root in found:
        if counted >= wanted:
            break
        kept.append(root)
        counted += root.times
    return kept


def null_vectors(matrix: list[list[int]], root: Root, seed: int = 0) -> list[list[float]]:
    """Orthonormal eigenvectors for ``root``, as many as its multiplicity, by inverse iteration in integers.

    With eigenvalue and matrix scaled by 2^bits the shifted matrix is an integer one. It is eliminated once with partial
    pivots in fixed point, and solved twice for each start; earlier vectors of the root are taken out of later ones.
    """
    size, bits = len(matrix), root.bits + 1 + _GUARD
    shift = (root.low + root.high) << _GUARD
    rows = np.array([[(x << bits) - (shift if i == j else 0) for j, x in enumerate(row)] for i, row in enumerate(matrix)], object)
    one = max(256, max(abs(int(x)) for row in rows for x in row).bit_length() + 2 * _GUARD)
    order, factors = list(range(size)), [[0] * size for _ in range(size)]
    for col in range(size):
        best = max(range(col, size), key=lambda r: abs(rows[r, col]))
        if best != col:
            rows[[col, best]] = rows[[best, col]]
            order[col], order[best] = order[best], order[col]
            factors[col], factors[best] = factors[best], factors[col]
        if not rows[col, col]:
            rows[col, col] = 1
        for r in range(col + 1, size):
            if rows[r, col]:
                factor = (int(rows[r, col]) << one) // int(rows[col, col])
                factors[r][col] = factor
                rows[r, col:] = rows[r, col:] - (rows[col, col:] * factor >> one)
    dice, found = np.random.default_rng(seed), []
    for _ in range(root.times):
        vector = [int(x) << one >> 62 for x in dice.integers(1, 1 << 62, size)]
        for _ in range(3):
            for other in found:
                share = sum(a * b for a, b in zip(vector, other, strict=True)) >> one
                vector = [a - (share * b >> one) for a, b in zip(vector, other, strict=True)]
            forward = [vector[i] for i in order]
            for r in range(size):
                forward[r] -= sum(f * x for f, x in zip(factors[r][:r], forward[:r], strict=True)) >> one
            solved = [0] * size
            for r in range(size - 1, -1, -1):
                rest = (forward[r] << one) - sum(int(a) * x for a, x in zip(rows[r, r + 1 :], solved[r + 1 :], strict=True))
                solved[r] = rest // int(rows[r, r])
            longest = max(abs(x) for x in solved)
            vector = [(x << one) // longest for x in solved]
        for other in found:
            share = sum(a * b for a, b in zip(vector, other, strict=True)) >> one
            vector = [a - (share * b >> one) for a, b in zip(vector, other, strict=True)]
        length = isqrt(sum(x * x for x in vector))
        found.append([(x << one) // length for x in vector])
    return [[float(Fraction(x, 1 << one)) for x in vector] for vector in found]

