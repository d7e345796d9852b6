"""Exact eigenvalues and eigenvectors of a symmetric matrix of whole numbers, positive semidefinite.

The characteristic polynomial comes from Hessenberg forms modulo primes, put together by Chinese
remainders. All its roots are real, so the sign changes of its coefficients, moved to begin at a point,
count the roots above that point exactly; roots are parted by such counts and then narrowed down by signs.
An eigenvector is a null vector of the matrix less its root, by inverse iteration in long decimals.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from decimal import Decimal, localcontext
from math import comb

import numpy as np

Matrix = Sequence[Sequence[int]]

#: Bits of the trace in the units of the roots, at least.
ROOT_BITS = 192
#: Digits of the inverse iteration, and its steps.
DIGITS, STEPS = 110, 3

# Bases that decide primality below 2^32.
_WITNESSES = (2, 3, 5, 7)


def _is_prime(n: int) -> bool:
    if n % 2 == 0:
        return n == 2
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in _WITNESSES:
        x = pow(base, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_for(matrix: Matrix) -> list[int]:
    """Primes below 2^31 whose product is over twice any coefficient of the polynomial.

    The roots are not negative and add up to the trace t, so the sum of the products of k of them is at
    most C(d, k) (t / d)^k.
    """
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    bound = 2 * max(comb(d, k) * trace**k // d**k + 1 for k in range(d + 1)) if d else 2
    found, product, n = [], 1, (1 << 31) - 1
    while product <= bound:
        if _is_prime(n):
            found.append(n)
            product *= n
        n -= 2
    return found


def polynomial_modulo(matrix: Matrix, p: int) -> list[int]:
    """Coefficients of det(x I - M) modulo p, the constant first."""
    d = len(matrix)
    a = np.array([[value % p for value in row] for row in matrix], np.int64).reshape(d, d)
    for k in range(1, d - 1):
        below = np.flatnonzero(a[k:, k - 1])
        if not len(below):
            continue
        if at := int(below[0]):
            a[[k, k + at]] = a[[k + at, k]]
            a[:, [k, k + at]] = a[:, [k + at, k]]
        times = a[k + 1 :, k - 1] * pow(int(a[k, k - 1]), -1, p) % p
        a[k + 1 :] = (a[k + 1 :] - times[:, None] * a[k] % p) % p
        a[:, k] = (a[:, k] + (a[:, k + 1 :] * times % p).sum(1)) % p
    found = np.zeros((d + 1, d + 1), np.int64)
    found[0, 0] = 1
    weight = np.zeros(d, np.int64)
    for k in range(d):
        # Entries above the diagonal, each times the product of the subdiagonal between.
        if k:
            weight[:k] = weight[:k] * a[k, k - 1] % p
        weight[k] = 1
        share = a[: k + 1, k] * weight[: k + 1] % p
        found[k + 1, 1:] = found[k, :-1]
        found[k + 1] = (found[k + 1] - (share[:, None] * found[: k + 1] % p).sum(0)) % p
    return found[d].tolist()


def from_remainders(primes: Sequence[int], remainders: Sequence[Sequence[int]]) -> list[int]:
    """Whole numbers, positive or negative, from their remainders by prime."""
    total = 1
    for p in primes:
        total *= p
    shares = [(total // p) * pow(total // p, -1, p) for p in primes]
    sums = [sum(r * s for r, s in zip(column, shares, strict=True)) % total for column in zip(*remainders, strict=True)]
    return [x - total if 2 * x > total else x for x in sums]


def _moved(coefficients: Sequence[int], by: int) -> list[int]:
    """Coefficients of q(x + by), the constant first."""
    out = list(coefficients)
    n = len(out)
    for i in range(n - 1):
        for j in range(n - 2, i - 1, -1):
            out[j] += by * out[j + 1]
    return out


def _above(coefficients: Sequence[int], point: int) -> int:
    """How many roots lie above the point, each as often as it occurs."""
    signs = [c > 0 for c in _moved(coefficients, point) if c]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def _sign(coefficients: Sequence[int], point: int) -> int:
    value = 0
    for c in reversed(coefficients):
        value = value * point + c
    return (value > 0) - (value < 0)


def top_roots(coefficients: Sequence[int], most: int, guesses: Sequence[float]) -> tuple[int, list[tuple[int, int]]]:
    """Bits b and the largest roots above zero as (root times 2^b rounded down, times it occurs), falling.

    At most ``most`` roots with repetition, but for the last one's repeats. Roots that agree in all bits
    count as one. ``guesses`` are approximate roots: points between them are tried first.
    """
    coefficients = list(coefficients)
    while coefficients[0] == 0 and len(coefficients) > 1:
        coefficients.pop(0)  # A root of zero.
    degree = len(coefficients) - 1
    if not degree:
        return 0, []
    trace = -coefficients[-2]
    bits = max(0, ROOT_BITS - trace.bit_length())
    scaled = [c << bits * (degree - k) for k, c in enumerate(coefficients)]
    high = (trace << bits) + 1
    near = sorted(int(g * 2.0**min(bits, 900)) << max(0, bits - 900) for g in guesses if g > 0)
    points = sorted({p for a, b in zip(near, near[1:], strict=False) if 0 < (p := (a + b) // 2) < high})
    spans, above = [], {high: 0}
    last, count = high, 0
    for point in [*reversed(points), 0]:
        above[point] = _above(scaled, point) if point else degree
        spans.append((point, last))
        last, count = point, above[point]
        if count >= most:
            break
    found, taken = [], 0
    spans.reverse()
    while spans and taken < most:
        low, top = spans.pop()  # The highest span that is left: roots in (low, top].
        n = above[low] - above[top]
        if not n:
            continue
        if n == 1:
            side = _sign(scaled, top)
            if side == 0:
                found.append((top, 1))
            else:
                while top - low > 1:
                    middle = (low + top) // 2
                    if _sign(scaled, middle) == side:
                        top = middle
                    else:
                        low = middle
                # A root at the lower end itself belongs to the span below.
                found.append((top if _sign(scaled, top) == 0 else low, 1))
        elif top - low <= 1:
            found.append((top if _sign(scaled, top) == 0 else low, n))
        else:
            middle = (low + top) // 2
            above[middle] = _above(scaled, middle)
            spans += [(low, middle), (middle, top)]
            continue
        taken += n
    return bits, found


def _factored(rows: np.ndarray, tiny: Decimal) -> tuple[np.ndarray, np.ndarray]:
    """LU of a matrix of decimals with row exchanges; a pivot of zero becomes ``tiny``."""
    a, order = rows.copy(), np.arange(len(rows))
    for k in range(len(a)):
        at = k + max(range(len(a) - k), key=lambda i: abs(a[k + i, k]))
        if at != k:
            a[[k, at]], order[[k, at]] = a[[at, k]], order[[at, k]]
        if a[k, k] == 0:
            a[k, k] = tiny
        if k + 1 < len(a):
            a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
            a[k + 1 :, k + 1 :] = a[k + 1 :, k + 1 :] - np.multiply.outer(a[k + 1 :, k], a[k, k + 1 :])
    return a, order


def _solved(lu: np.ndarray, order: np.ndarray, right: np.ndarray) -> np.ndarray:
    x = right[order].copy()
    for i in range(1, len(x)):
        x[i] = x[i] - (lu[i, :i] * x[:i]).sum()
    for i in range(len(x) - 1, -1, -1):
        if i + 1 < len(x):
            x[i] = x[i] - (lu[i, i + 1 :] * x[i + 1 :]).sum()
        x[i] = x[i] / lu[i, i]
    return x


def eigenvectors(matrix: Matrix, bits: int, root: int, times: int) -> Iterator[list[float]]:
    """``times`` orthogonal unit vectors of the root; each one's largest entry is positive."""
    d = len(matrix)
    with localcontext() as context:
        context.prec = DIGITS
        context.Emax, context.Emin = 10**9, -(10**9)
        less = Decimal(root) / Decimal(2) ** bits
        rows = np.array([[Decimal(int(v)) for v in row] for row in matrix], object).reshape(d, d)
        for i in range(d):
            rows[i, i] -= less
        size = max(abs(v) for v in rows.ravel()) or Decimal(1)
        lu, order = _factored(rows, size * Decimal(10) ** -DIGITS)
        # Any start will do that is not orthogonal to the null space.
        draws = np.random.default_rng(d).integers(1, 1 << 20, (times, d))
        found = [np.array([Decimal(int(v)) for v in draw], object) for draw in draws]
        for _ in range(STEPS):
            unit = []
            for vector in found:
                vector = _solved(lu, order, vector)
                vector = vector / max(abs(v) for v in vector)
                for _ in range(2):
                    for other in unit:
                        vector = vector - other * (other * vector).sum()
                unit.append(vector / (vector * vector).sum().sqrt())
            found = unit
        for vector in found:
            largest = max(range(d), key=lambda i: (abs(vector[i]), -i))
            yield [float(v) * (1 if vector[largest] > 0 else -1) for v in vector]
