"""Texts of a batch as numpy arrays: words, lines and their hashes, without a Python loop
over words. Equal runs have equal hashes wherever they stand. A word or line adds up its
bytes, each times a random number of its place; a range of a sequence is a polynomial modulo
the prime 2^61 - 1. Over the choice of these numbers two unlike runs agree with a chance of
2^-56, two unlike ranges of n numbers with one of n / 2^61, whatever they are made of."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text looked at together; a longer text is a block of its own.
BLOCK_BYTES = 1 << 19

_RNG = np.random.default_rng(20240229)
BYTE_NUMBERS = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_FROM_ONE = np.arange(1, 257, dtype=np.uint64)
_IN_WORDS = np.where(_WHITE, np.uint64(0), _FROM_ONE)
_IN_LINES = _FROM_ONE.copy()
_IN_LINES[0x0A] = 0
_places = np.zeros(0, np.uint64)


def place_numbers(n: int) -> np.ndarray:
    """A random number for each of the first ``n`` places, kept for the next call."""
    global _places
    if len(_places) < n:
        size = 1 << max(10, (n - 1).bit_length())
        _places = mixed(np.arange(1, size + 1, dtype=np.uint64) * BASE)
    return _places[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _run_hashes(numbers: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hash of each run: from a start to the next, where bytes outside runs count 0."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    first = np.zeros(len(numbers), np.int64)
    first[starts] = starts
    place = np.arange(len(numbers)) - np.maximum.accumulate(first)
    place[: starts[0]] = 0
    weighed = numbers * place_numbers(int(place.max()) + 1)[place]
    sums = np.add.reduceat(weighed, starts)
    return mixed(sums + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


@dataclass
class Block:
    """Some whole texts in a row; each is followed by one white-space byte."""

    data: np.ndarray  # bytes
    bounds: np.ndarray  # where each text starts, and where one more would

    @property
    def n(self) -> int:
        return len(self.bounds) - 1

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of each word, and for each text the number of words before it."""
        white = _WHITE[self.data]
        edge = np.flatnonzero(white[1:] != white[:-1]) + 1
        if len(white) and not white[0]:
            edge = np.concatenate([[0], edge])
        starts, ends = edge[0::2], edge[1::2]
        return starts, ends, np.searchsorted(starts, self.bounds)

    def word_hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _run_hashes(_IN_WORDS[self.data], starts, ends - starts)

    def lines(self, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each line; ``separator`` marks the bytes after texts."""
        breaks = (self.data == 0x0A) | separator
        ends = np.flatnonzero(breaks)
        return np.concatenate([[0], ends[:-1] + 1]), ends

    def line_hashes(self, starts: np.ndarray, ends: np.ndarray, separator: np.ndarray) -> np.ndarray:
        numbers = _IN_LINES[self.data]
        numbers[separator] = 0
        return _run_hashes(numbers, starts, ends - starts)


def blocks(texts: pa.Array, most: int = BLOCK_BYTES) -> Iterator[tuple[int, Block]]:
    """The texts of a column (nulls empty), with the place of each block's first text."""
    values = [b"" if x is None else x.encode() for x in texts.to_pylist()]
    at = 0
    while at < len(values):
        end, size = at, 0
        while end < len(values) and (end == at or size + len(values[end]) < most):
            size += len(values[end]) + 1
            end += 1
        part = values[at:end]
        data = np.frombuffer(b"\n".join(part) + b"\n", np.uint8)
        lengths = np.fromiter(map(len, part), np.int64, len(part))
        yield at, Block(data, np.concatenate([[0], np.cumsum(lengths + 1)]))
        at = end


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the values between bounds."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


ODD = np.uint64(0xD1342543DE82EF95)
PRIME = np.uint64(2**61 - 1)
STRETCH = 1 << 14
_LOW_31, _LOW_30, _LOW_29 = np.uint64(2**31 - 1), np.uint64(2**30 - 1), np.uint64(2**29 - 1)


def _reduced(x: np.ndarray) -> np.ndarray:
    """Any 64-bit numbers modulo the prime."""
    x = (x & PRIME) + (x >> np.uint64(61))
    return np.where(x >= PRIME, x - PRIME, x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime, of numbers below it; a stretch at a time, so that what
    lies between stays in the cache and long texts take no memory for it."""
    out = np.empty(len(a), np.uint64)
    for at in range(0, len(a), STRETCH):
        here = slice(at, at + STRETCH)
        out[here] = _product(a[here], b[here])
    return out


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a_high, a_low = a >> np.uint64(31), a & _LOW_31
    b_high, b_low = b >> np.uint64(31), b & _LOW_31
    middle = a_low * b_high + a_high * b_low
    total = a_high * b_high * np.uint64(2) + a_low * b_low
    total += (middle >> np.uint64(30)) + ((middle & _LOW_30) << np.uint64(31))
    return _reduced(total)


_powers: dict[int, np.ndarray] = {}


def _powers_of(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers modulo the prime, kept for the next call."""
    known = _powers.get(base, np.ones(1, np.uint64))
    while len(known) < n:
        step = np.uint64(pow(base, len(known), int(PRIME)))
        known = np.concatenate([known, times(known, np.full(len(known), step))])
    _powers[base] = known
    return known[:n]


#: Two random bases, for hashes that do not fail together.
BASES = tuple(int(x) for x in _RNG.integers(2**32, int(PRIME), 2))


def _sums_before(terms: np.ndarray) -> np.ndarray:
    """Sums modulo the prime of the terms before each, and of all."""
    # Halves are added up apart, which less than 2^32 terms do not overflow.
    low = np.cumsum(terms & np.uint64(2**32 - 1), dtype=np.uint64)
    high = _reduced(np.cumsum(terms >> np.uint64(32), dtype=np.uint64))
    high = ((high & _LOW_29) << np.uint64(32)) + (high >> np.uint64(29))
    sums = np.zeros(len(terms) + 1, np.uint64)
    sums[1:] = _reduced(_reduced(low) + high)
    return sums


def _named(before: np.ndarray, until: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int):
    """Hashes of stretches from the sums before their starts and until their ends."""
    between = _reduced(until + (PRIME - before))
    most = int(starts.max(initial=0)) + 1
    raw = times(between, _powers_of(pow(base, -1, int(PRIME)), most)[starts])
    return mixed(raw + (ends - starts).astype(np.uint64) * ODD)


class RangeHashes:
    """Hashes of any stretch of a sequence of numbers, from sums over its beginnings."""

    def __init__(self, numbers: np.ndarray, base: int = BASES[0]) -> None:
        self.base = base
        self.sums = _sums_before(times(_reduced(numbers), _powers_of(base, len(numbers))))

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _named(self.sums[starts], self.sums[ends], starts, ends, self.base)


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASES[0]):
    """Hashes of some stretches of bytes. Products of a byte and the halves of a power need
    no reduction, and are added up between the places asked for alone."""
    apart = np.arange(0, len(data), 1 << 20)
    marks = np.unique(np.concatenate([apart, starts, ends]))
    inside = marks[marks < len(data)]
    numbers, power = data.astype(np.uint64) + np.uint64(1), _powers_of(base, len(data))
    low = np.add.reduceat(numbers * (power & _LOW_31), inside)
    high = np.add.reduceat(numbers * (power >> np.uint64(31)), inside)
    high = ((high & _LOW_30) << np.uint64(31)) + (high >> np.uint64(30))
    sums = _sums_before(_reduced(_reduced(low) + high))
    before, until = sums[np.searchsorted(marks, starts)], sums[np.searchsorted(marks, ends)]
    return _named(before, until, starts, ends, base)


_gram_powers: dict[int, np.ndarray] = {}


def _gram_powers_of(base: int, n: int) -> np.ndarray:
    known = _gram_powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(1 << max(10, (n - 1).bit_length()), base, np.uint64)
        steps[0] = 1
        known = _gram_powers[base] = np.multiply.accumulate(steps)
    return known[:n]


def gram_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Cheap hashes of all runs of ``width`` bytes, modulo 2^64: equal runs have equal ones,
    and crafted unlike runs may have, so they choose and file but tell nothing apart."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_NUMBERS[data] * _gram_powers_of(int(BASE), n), out=sums[1:])
    inverse = _gram_powers_of(pow(int(BASE), -1, 2**64), n - width + 1)
    return mixed((sums[width:] - sums[: n + 1 - width]) * inverse)
