"""Stretches of windows around content-chosen anchors, over sequences of symbols.

Every window of `width` symbols owns one anchor: the leftmost of its grams (of `gram`
symbols) with the smallest hash.  Neighbouring windows mostly own the same anchor and make
up a stretch.  Equal windows own equal anchors at the same place, so a window whose anchor
occurs once in a corpus occurs once itself; that is what lets the searches for repeats
look at few symbols without missing any.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from typing import NamedTuple

import numpy as np



def remembered(function: Callable) -> Callable:
    """Like functools.cache, but a plain function, which can travel to executors."""
    known: dict = {}

    def call(*args):
        if args not in known:
            known[args] = function(*args)
        return known[args]

    return call


U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
OTHER_BASE = 0xD1B54A32D192ED03 | 1


class Stretches(NamedTuple):
    """Arrays with one entry for each stretch."""

    anchor: np.ndarray  # hash of the anchor gram
    start: np.ndarray  # first window's first symbol
    windows: np.ndarray  # number of windows
    content: np.ndarray  # hash of all symbols of the stretch


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(29))
    x = x * U64(0xBF58476D1CE4E5B9)
    return x ^ (x >> U64(32))


@remembered
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i up to n."""
    inverse = pow(base, -1, 1 << 64)
    up, down = np.full(n + 1, base, U64), np.full(n + 1, inverse, U64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def _sums(symbols: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = _powers(base, 1 << (len(symbols)).bit_length())
    sums = np.zeros(len(symbols) + 1, U64)
    np.cumsum(symbols * up[: len(symbols)], out=sums[1:])
    return sums, down


def span_hashes(
    symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASE
) -> np.ndarray:
    """A hash of each symbols[start:end]; equal spans have equal hashes."""
    sums, down = _sums(symbols, base)
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))


def _leftmost_least(values: np.ndarray, n: int) -> np.ndarray:
    """For each run of n values, the index of its leftmost least one."""
    best, at = values, np.arange(len(values), dtype=np.int32)
    done = 1
    while done < n:
        step = min(done, n - done)
        later = best[step:] < best[:-step]
        at = np.where(later, at[step:], at[:-step])
        best = np.where(later, best[step:], best[:-step])
        done += step
    return at


def stretches(symbols: np.ndarray, width: int, gram: int) -> Stretches:
    """All stretches of one sequence; `symbols` are 64-bit numbers."""
    n = len(symbols) - width + 1
    if n <= 0:
        none = np.zeros(0, U64)
        return Stretches(none, none.astype(np.int64), none.astype(np.int64), none)
    grams = span_hashes(
        symbols,
        first := np.arange(len(symbols) - gram + 1),
        first + gram,
    )
    owner = _leftmost_least(grams, width - gram + 1)
    cut = np.flatnonzero(np.diff(owner)) + 1
    start = np.concatenate([[0], cut])
    windows = np.diff(np.concatenate([start, [n]]))
    end = start + windows + width - 1
    return Stretches(
        grams[owner[start]],
        start,
        windows,
        span_hashes(symbols, start, end),
    )


#: Bytes that separate words: space, tab, line feed, vertical tab, form feed, return.
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
#: A 64-bit number for each byte.
BYTE_SYMBOLS = mix(np.arange(256, dtype=U64) + U64(0x5851F42D4C957F2D))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word of a text's bytes, and the byte after its last."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~BLANK[data]
    change = np.diff(inside)
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


#: Bytes of a word from which on it is hashed by itself.
LONG_WORD = 64


def word_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of each word of a text's bytes.

    Modulo 2**64, long words of two letters that are unlike everywhere can agree in a
    polynomial whatever its base (from 1,024 letters on), so long words get a digest.
    """
    starts, ends = word_spans(data)
    hashes = span_hashes(BYTE_SYMBOLS[data], starts, ends)
    for at in np.flatnonzero(ends - starts > LONG_WORD):
        word = data[starts[at] : ends[at]].tobytes()
        hashes[at] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return hashes
