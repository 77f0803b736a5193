"""Exact algebra of integer matrices: characteristic polynomials, their roots, null vectors.

The polynomial is found modulo primes by reduction to Hessenberg form and put together
by Chinese remainders. All roots of a symmetric matrix are real, so the sign changes of
the polynomial's coefficients, moved to a point, count the roots above it exactly,
multiple ones included; bisection on a binary grid isolates them.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal, localcontext
from math import isqrt, prod

import numpy as np

#: Binary digits behind the point to which roots are found.
GRID = 64
#: Inverse iterations; the first one already meets the root's accuracy.
ITERATIONS = 3


def _is_prime(n: int) -> bool:
    """Deterministic below 3.2e9 with these bases."""
    d, s = n - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for base in (2, 3, 5, 7):
        x = pow(base, d, n)
        if x in (1, n - 1):
            continue
        for _ in range(s - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_for(bound: int) -> list[int]:
    """Primes under 2^31, whose product exceeds twice the bound."""
    found, product, n = [], 1, 2**31 - 1
    while product <= 2 * bound:
        if _is_prime(n):
            found.append(n)
            product *= n
        n -= 2
    return found


def coefficient_bound(matrix: list[list[int]]) -> int:
    """At least the size of any coefficient of a positive semidefinite matrix.

    A coefficient is a sum of principal minors, and such a minor is at most the
    product of its diagonal.
    """
    sums = [1]
    for i in range(len(matrix)):
        x = matrix[i][i]
        sums = [a + x * b for a, b in zip([*sums, 0], [0, *sums], strict=True)]
    return max(sums)


def hessenberg(matrix: np.ndarray, p: int) -> np.ndarray:
    """A similar matrix modulo ``p`` with zeros below the first lower diagonal."""
    a = matrix.copy()
    for k in range(len(a) - 2):
        below = np.flatnonzero(a[k + 1 :, k])
        if not len(below):
            continue
        i = k + 1 + int(below[0])
        if i != k + 1:
            a[[i, k + 1]] = a[[k + 1, i]]
            a[:, [i, k + 1]] = a[:, [k + 1, i]]
        factors = a[k + 2 :, k] * pow(int(a[k + 1, k]), -1, p) % p
        a[k + 2 :] = (a[k + 2 :] - factors[:, None] * a[k + 1] % p) % p
        a[:, k + 1] = (a[:, k + 1] + (a[:, k + 2 :] * factors % p).sum(axis=1)) % p
    return a


def polynomial_modulo(matrix: list[list[int]], p: int) -> list[int]:
    """Coefficients of det(x I - matrix) modulo ``p``, the highest power first."""
    h = hessenberg(np.array([[x % p for x in row] for row in matrix], np.int64).reshape(len(matrix), -1), p)
    d = len(h)
    # Row k holds the polynomial of the leading k x k block, the lowest power first.
    leading = np.zeros((d + 1, d + 1), np.int64)
    leading[0, 0] = 1
    for k in range(d):
        weights, product = np.zeros(k + 1, np.int64), 1
        for i in range(k, -1, -1):
            weights[i] = int(h[i, k]) * product % p
            product = product * int(h[i, i - 1]) % p if i else 0
        moved = np.roll(leading[k], 1)
        leading[k + 1] = (moved - (weights[:, None] * leading[: k + 1] % p).sum(axis=0)) % p
    return [int(x) for x in leading[d][::-1]]


def recombined(residues: dict[int, list[int]]) -> list[int]:
    """The signed integers with these residues modulo each prime."""
    whole = prod(residues)
    parts = [(whole // p) * pow(whole // p, -1, p) for p in residues]
    sums = (sum(r * part for r, part in zip(row, parts, strict=True)) % whole for row in zip(*residues.values(), strict=True))
    return [x - whole if x > whole // 2 else x for x in sums]


def roots_above(polynomial: list[int], point: int) -> int:
    """How many roots are greater than an integer, for a polynomial of real roots only."""
    moved = list(polynomial)
    for end in range(len(moved), 1, -1):
        for i in range(1, end):
            moved[i] += point * moved[i - 1]
    signs = [x > 0 for x in moved if x]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def _value(polynomial: list[int], point: int) -> int:
    total = 0
    for c in polynomial:
        total = total * point + c
    return total


def largest_roots(polynomial: list[int], count: int, above: int) -> list[tuple[int, int]]:
    """The largest positive roots, as (numerator over 2^GRID, multiplicity), falling.

    ``above`` is an integer no root exceeds. A root lies at most 1 under its numerator.
    Roots closer than the grid count as one multiple root. A multiple root that starts
    within ``count`` is given with its whole multiplicity.
    """
    fine = [c << (GRID * k) for k, c in enumerate(polynomial)]
    found: list[tuple[int, int]] = []
    # (low, high]: the numbers of roots above either end are known; the highest is last.
    open_ = [(0, above << GRID, roots_above(fine, 0), 0)]
    while open_ and sum(m for _, m in found) < count:
        low, high, over_low, over_high = open_.pop()
        inside = over_low - over_high
        if not inside:
            continue
        if inside == 1:
            found.append((_bisected(fine, low, high, over_low), 1))
        elif high - low == 1:
            found.append((high, inside))
        else:
            middle = (low + high) // 2
            over = roots_above(fine, middle)
            open_ += [(low, middle, over_low, over), (middle, high, over, over_high)]
    return found


def _bisected(polynomial: list[int], low: int, high: int, over_low: int) -> int:
    """The upper end of the grid cell of the one simple root in (low, high]."""
    negative = over_low % 2 == 1
    while high - low > 1:
        middle = (low + high) // 2
        value = _value(polynomial, middle)
        if value == 0:
            return middle
        low, high = (middle, high) if (value < 0) == negative else (low, middle)
    return high


def _lu(matrix: np.ndarray, tiny: Decimal) -> tuple[np.ndarray, list[int]]:
    a, order = matrix.copy(), list(range(len(matrix)))
    for k in range(len(a)):
        i = max(range(k, len(a)), key=lambda r: abs(a[r, k]))
        if i != k:
            a[[i, k]] = a[[k, i]]
            order[i], order[k] = order[k], order[i]
        if abs(a[k, k]) < tiny:
            a[k, k] = tiny
        a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
        a[k + 1 :, k + 1 :] = a[k + 1 :, k + 1 :] - np.outer(a[k + 1 :, k], a[k, k + 1 :])
    return a, order


def _solved(a: np.ndarray, order: list[int], right: np.ndarray) -> np.ndarray:
    x = right[order]
    for k in range(1, len(a)):
        x[k] = x[k] - a[k, :k].dot(x[:k])
    for k in range(len(a) - 1, -1, -1):
        rest = a[k, k + 1 :].dot(x[k + 1 :]) if k + 1 < len(a) else Decimal(0)
        x[k] = (x[k] - rest) / a[k, k]
    return x


def null_vectors(matrix: list[list[int]], root: int, multiplicity: int) -> list[list[float]]:
    """Orthonormal vectors that ``matrix`` multiplies by root / 2^GRID, as doubles.

    Inverse iteration in decimals with some forty digits more than the entries have,
    so that also neighbouring roots are told apart.
    """
    d = len(matrix)
    size = len(str(max(sum(abs(x) for x in row) for row in matrix)))
    with localcontext() as context:
        context.prec = size + 60
        # The middle of the grid cell, so that an exact root is no exact zero pivot.
        shift = (Decimal(root) - Decimal("0.5")) / (1 << GRID)
        moved = np.array([[Decimal(x) for x in row] for row in matrix], object).reshape(d, d)
        for i in range(d):
            moved[i, i] -= shift
        a, order = _lu(moved, Decimal(10) ** -40)
        start = np.random.default_rng(d).integers(-1000, 1000, (multiplicity, d))
        vectors = [np.array([Decimal(int(x)) for x in row], object) for row in start]
        for _ in range(ITERATIONS):
            fresh: list[np.ndarray] = []
            for v in vectors:
                x = _solved(a, order, v)
                for _ in range(2):
                    for u in fresh:
                        x = x - u * u.dot(x)
                fresh.append(x / x.dot(x).sqrt())
            vectors = fresh
        return [_signed([float(x) for x in v]) for v in vectors]


def _signed(vector: list[float]) -> list[float]:
    """The vector or its negative: its entry of greatest size is positive."""
    largest = max(vector, key=abs)
    return vector if largest > 0 else [-x for x in vector]


def square_root(numerator: int) -> float:
    """The square root of numerator / 2^GRID, right to the last digits."""
    return isqrt(numerator << 128) / 2 ** (64 + GRID // 2)


def limbs(value: int) -> Iterator[tuple[int, int]]:
    """Parts of a whole number, each under 2^32, with their places; signed alike."""
    sign, rest, place = (-1 if value < 0 else 1), abs(value), 0
    while rest or not place:
        yield place, sign * (rest & 0xFFFFFFFF)
        rest, place = rest >> 32, place + 1
