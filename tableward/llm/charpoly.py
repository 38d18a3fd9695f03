"""Exact characteristic polynomials of symmetric integer matrices, their roots and their vectors.

The polynomial of an integer matrix has integer coefficients.  They are found modulo many
31-bit primes, where a Hessenberg form gives each residue in cubic time, and put together
by the Chinese remainder theorem; there is no rounding anywhere.  A symmetric matrix has
real roots only, and for such a polynomial Descartes' rule is exact: the sign changes of
P(x + a) count the roots above a, repeated ones as often.  So roots are bracketed by whole
numbers over a power of two, as tightly as wished.  A root's vector comes from inverse
iteration in decimal arithmetic next to the bracket.

Work and memory follow the matrix, which has the vectors' dimension and not their number.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal, localcontext

import numpy as np

#: Bits to which a root is bracketed, and the decimal digits its vector is computed with.
BITS, DIGITS = 200, 110


def _prime(n: int) -> bool:
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):  # enough for all numbers under 3,215,031,751
        x = pow(base, odd, n)
        if x not in (1, n - 1) and not any((x := x * x % n) == n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes(above: int) -> list[int]:
    """The largest primes under 2^31, as many as make their product greater than ``above``."""
    found, product, n = [], 1, (1 << 31) - 1
    while product <= above:
        if _prime(n):
            found.append(n)
            product *= n
        n -= 2
    return found


def needed(trace: int, size: int) -> int:
    """A number that twice the size of every coefficient stays under, if no root is negative.

    The coefficients' sizes sum to the product of 1 + root, which is largest when all roots are equal.
    """
    return 2 * (trace // size + 2) ** size


def hessenberg(a: np.ndarray, p: int) -> np.ndarray:
    """A matrix similar to ``a`` modulo ``p`` with zeros below its first subdiagonal."""
    a = a % p
    for k in range(1, len(a) - 1):
        below = np.flatnonzero(a[k:, k - 1])
        if not len(below):
            continue
        if below[0]:
            swap = [k, k + below[0]]
            a[swap] = a[swap[::-1]]
            a[:, swap] = a[:, swap[::-1]]
        times = a[k + 1 :, k - 1] * pow(int(a[k, k - 1]), -1, p) % p
        a[k + 1 :] = (a[k + 1 :] - times[:, None] * a[k]) % p
        a[:, k] = (a[:, k] + (a[:, k + 1 :] * times % p).sum(axis=1)) % p
    return a


def polynomial_mod(matrix: list[list[int]], p: int) -> list[int]:
    """The coefficients of det(x - matrix) modulo ``p``, the constant one first."""
    h = hessenberg(np.array([[v % p for v in row] for row in matrix], np.int64), p)
    size = len(h)
    known = np.zeros((size + 1, size + 1), np.int64)  # row k: the polynomial of the leading k x k block
    known[0, 0] = 1
    chain = np.zeros(0, np.int64)  # products of the subdiagonal from each row up to the one in hand
    for k in range(1, size + 1):
        row = np.roll(known[k - 1], 1) - h[k - 1, k - 1] * known[k - 1] % p
        if k > 1:
            chain = np.append(chain, 1) * h[k - 1, k - 2] % p
            row -= ((h[: k - 1, k - 1] * chain % p)[:, None] * known[: k - 1] % p).sum(axis=0)
        known[k] = row % p
    return known[size].tolist()


def combined(residues: Iterator[tuple[int, list[int]]]) -> list[int]:
    """The coefficients from their residues modulo primes whose product is large enough."""
    product, found = 1, None
    for p, got in residues:
        if found is None:
            found = [0] * len(got)
        back = pow(product, -1, p)
        found = [c + product * ((r - c) * back % p) for c, r in zip(found, got)]
        product *= p
    return [c - product if 2 * c > product else c for c in found or []]


class Roots:
    """The roots of a polynomial that has real roots only, none of them negative."""

    def __init__(self, coefficients: list[int]):
        zeros = next(i for i, c in enumerate(coefficients) if c)
        self.coefficients = coefficients[zeros:]
        #: How many are above zero.
        self.positive = len(self.coefficients) - 1

    def scaled(self, bits: int) -> list[int]:
        """The polynomial whose roots are 2^bits times as large, the leading coefficient first."""
        return [c << bits * i for i, c in enumerate(reversed(self.coefficients))]

    def above(self, a: int, bits: int) -> int:
        """How many roots are above a / 2^bits."""
        row = self.scaled(bits)
        for end in range(len(row) - 1, 0, -1):
            for i in range(1, end + 1):
                row[i] += a * row[i - 1]
        signs = [c > 0 for c in row if c]
        return sum(x != y for x, y in zip(signs, signs[1:]))

    def sign(self, a: int, bits: int) -> int:
        """The sign at a / 2^bits."""
        value = 0
        for c in self.scaled(bits):
            value = value * a + c
        return (value > 0) - (value < 0)

    def bracket(self, rank: int, accuracy: int = BITS) -> tuple[int, int, int, int]:
        """``low, bits, before, times`` of the root that is ``rank``-th from above, counted from 1.

        It is over low / 2^bits and at most (low + 1) / 2^bits, where low has ``accuracy``
        bits at least; ``before`` roots lie above that and ``times`` roots inside.
        """
        low, high, bits = 0, 1, 0
        under, over = self.positive, self.above(1, 0)
        while over >= rank:
            low, high, under, over = high, 2 * high, over, self.above(2 * high, 0)
        while high - low > 1 or low.bit_length() < accuracy:
            if high - low == 1:
                low, high, bits = 2 * low, 2 * high, bits + 1
            middle = (low + high) // 2
            if under - over == 1:  # the only root inside: the polynomial changes its sign there
                sign = self.sign(middle, bits)
                right = sign != 0 and (sign > 0) == (rank % 2 == 0)
                count = under if right else over
            else:
                count = self.above(middle, bits)
                right = count >= rank
            if right:
                low, under = middle, count
            else:
                high, over = middle, count
        return low, bits, over, under - over


def _start(size: int, turn: int) -> list[int]:
    """Whole numbers without a pattern."""
    state, found = 12345 + turn, []
    for _ in range(size):
        state = (6364136223846793005 * state + 1442695040888963407) % (1 << 64)
        found.append((state >> 40) - (1 << 23))
    return found


def eigenvectors(matrix: list[list[int]], low: int, bits: int, times: int) -> tuple[Decimal, np.ndarray]:
    """A root and ``times`` unit vectors at right angles that span its null space, as rows.

    The shift lies just below the bracket, so that the shifted matrix can be inverted; both
    steps of the iteration multiply what lies in the null space by about 2^BITS.  Of each
    vector the largest entry is positive.
    """
    size = len(matrix)
    with localcontext() as context:
        context.prec = DIGITS
        shift = Decimal(low - 1) / (1 << bits)
        a = np.array([[Decimal(v) for v in row] for row in matrix], object)
        a[np.arange(size), np.arange(size)] -= shift
        order, tiny = list(range(size)), Decimal(10) ** (-DIGITS) * (shift + 1)
        for k in range(size):
            best = max(range(k, size), key=lambda i: abs(a[i, k]))
            if best != k:
                a[[k, best]] = a[[best, k]]
                order[k], order[best] = order[best], order[k]
            if not a[k, k]:
                a[k, k] = tiny
            a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
            a[k + 1 :, k + 1 :] -= np.outer(a[k + 1 :, k], a[k, k + 1 :])
        found: list[np.ndarray] = []
        for turn in range(times):
            v = np.array([Decimal(x) for x in _start(size, turn)], object)
            for _ in range(2):
                v = v[order]
                for k in range(size):
                    v[k + 1 :] -= a[k + 1 :, k] * v[k]
                for k in reversed(range(size)):
                    v[k] = v[k] / a[k, k]
                    v[:k] -= a[:k, k] * v[k]
                for _ in range(2):
                    for other in found:
                        v = v - other * (other * v).sum()
                v = v / (v * v).sum().sqrt()
            found.append(v)
        rows = np.array([[float(x) for x in v] for v in found]).reshape(times, size)
        rows *= np.sign(rows[np.arange(times), np.abs(rows).argmax(axis=1)])[:, None]
        return Decimal(2 * low + 1) / (1 << bits + 1), rows
