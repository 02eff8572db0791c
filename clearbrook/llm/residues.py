"""Exact integer inner products from float32 matrix products modulo small primes.

Each prime's component matrices hold residues between ``-p / 2`` and ``p / 2``. Over ``SLAB`` columns a product of two
of them stays below 2**24 in size, up to where float32 holds every integer, so the order of summation does not matter
and nothing is rounded. As many primes are taken as the largest possible score needs; Chinese remaindering in mixed
radix gives back the signed score.
"""

from __future__ import annotations

import numpy as np

#: Columns multiplied at a time: ``SLAB * (1021 // 2) ** 2`` is below 2**24.
SLAB = 64
#: Scores beyond this size are given as this size, with their sign: results are 64-bit numbers.
LARGEST = (1 << 63) - 2
#: Below this bound scores are put together in 64-bit arithmetic, above it in Python's integers.
_NARROW = 1 << 61


def _primes(below: int) -> list[int]:
    """Primes under ``below`` and over its half, the largest first."""
    return [n for n in range(below - 1, below // 2, -1) if all(n % d for d in range(2, int(n**0.5) + 1))]


PRIMES = _primes(1024)


def bound(left: np.ndarray, right: np.ndarray) -> int:
    """No inner product of a row of ``left`` and one of ``right`` is larger than this."""
    if not left.size or not right.size:
        return 0
    return left.shape[1] * int(np.abs(left).max()) * int(np.abs(right).max())


def moduli(largest: int) -> list[int]:
    """The fewest primes whose product tells all numbers from ``-largest`` to ``largest`` apart."""
    chosen, product = [], 1
    for prime in PRIMES:
        if product > 2 * largest:
            break
        chosen.append(prime)
        product *= prime
    if product <= 2 * largest:
        raise ArithmeticError("scores beyond all primes of the list")
    return chosen


def residues(matrix: np.ndarray, prime: int) -> np.ndarray:
    """Whole numbers of any size, held in float64, modulo ``prime``; the remainder of floats is exact."""
    rest = np.fmod(matrix, prime)
    rest[rest > prime // 2] -= prime
    rest[rest < -(prime // 2)] += prime
    return rest.astype(np.float32)


def _product(left: np.ndarray, right: np.ndarray, prime: int) -> np.ndarray:
    """The product modulo ``prime``, from 0 up."""
    total = np.zeros((len(left), len(right)), np.int64)
    for at in range(0, left.shape[1], SLAB):
        total += (left[:, at : at + SLAB] @ right[:, at : at + SLAB].T).astype(np.int64)
    return total % prime


def scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """All inner products of the rows of two float64 matrices of whole numbers, as int64."""
    largest = bound(left, right)
    primes = moduli(largest)
    wide = largest >= _NARROW
    digits: list[np.ndarray] = []
    for k, prime in enumerate(primes):
        digit = _product(residues(left, prime), residues(right, prime), prime)
        for known, other in zip(digits, primes[:k]):
            digit = (digit - known) * pow(other, -1, prime) % prime
        digits.append(digit)
    modulus, value = 1, np.zeros((len(left), len(right)), object if wide else np.int64)
    for digit, prime in zip(digits, primes):
        # In 64 bits the last digits may wrap round; taking off the modulus below wraps back to the true score.
        value = value + (digit.astype(object) * modulus if wide else _wrapped(digit, modulus))
        modulus *= prime
    if wide:
        value = np.where(value > modulus // 2, value - modulus, value)
        return np.clip(value, -LARGEST, LARGEST).astype(np.int64)
    negative = _above_half(digits, primes, modulus)
    return np.where(negative, value - np.int64(_signed(modulus)), value)


def _signed(number: int) -> int:
    """A whole number modulo 2**64, as a signed one."""
    return (number + (1 << 63)) % (1 << 64) - (1 << 63)


def _wrapped(digit: np.ndarray, factor: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return digit * np.int64(_signed(factor))


def _above_half(digits: list[np.ndarray], primes: list[int], modulus: int) -> np.ndarray:
    """Where mixed-radix numbers are larger than half of the modulus: from the highest digit down."""
    half, limits = modulus // 2, []
    for prime in primes:
        limits.append(half % prime)
        half //= prime
    above = np.zeros(digits[0].shape, bool) if digits else np.zeros((), bool)
    for digit, limit in zip(digits, limits):  # a higher digit decides over all lower ones
        above = (digit > limit) | ((digit == limit) & above)
    return above
