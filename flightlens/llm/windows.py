"""Anchors of fixed-length strings: positions that equal strings share, whatever surrounds them.

Of the byte strings of ``GRAM`` bytes inside a string of ``LENGTH``, the one with the least hash (the first of
equals) is its anchor. Equal strings have their anchors at the same place, so comparing what hangs on
anchors finds every equal pair, with one anchor for about thirty bytes of text. Strings that follow one
another and share an anchor form a stretch.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LENGTH = 100
GRAM = 32

_BASE = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(42).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grown(which: int, base: int, n: int) -> np.ndarray:
    """The first n powers of the base modulo 2 ** 64; kept for the next call."""
    if len(_powers[which]) < n:
        with np.errstate(over="ignore"):
            _powers[which] = np.concatenate([[np.uint64(1)], np.cumprod(np.full(max(n, 1 << 21), base, np.uint64))])
    return _powers[which][:n]


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x ^ x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(29)
        return x


class Hashes:
    """Hashes of any stretch of some bytes, alike wherever the stretch begins."""

    def __init__(self, data: np.ndarray):
        with np.errstate(over="ignore"):
            self.sums = np.empty(len(data) + 1, np.uint64)
            self.sums[0] = 0
            np.multiply(_BYTES[data], _grown(0, _BASE, len(data)), out=self.sums[1:])
            np.cumsum(self.sums, out=self.sums)
        self.back = _grown(1, pow(_BASE, -1, 1 << 64), len(data) + 1)

    def of(self, starts: np.ndarray | slice, stops: np.ndarray | slice) -> np.ndarray:
        with np.errstate(over="ignore"):
            terms = self.sums[stops] - self.sums[starts]
            terms *= self.back[starts]
            return mix(terms)


@dataclass
class Stretches:
    """Strings by anchor: the anchor, the first and the last start of the strings that share it."""
    anchor: np.ndarray
    first: np.ndarray
    last: np.ndarray


def stretches(hashes: Hashes, owner: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> Stretches:
    """All stretches of the bytes behind ``hashes``; strings stay within one ``owner``."""
    n = len(owner)
    none = np.empty(0, np.int64)
    if n < length:
        return Stretches(none, none, none)
    bits = np.uint64((1 << 28) - 1)  # places in the low bits: the first of equals is least
    if n > int(bits):
        raise ValueError("work on at most 2 ** 28 bytes at a time")
    grams = n - gram + 1
    least = hashes.of(slice(0, grams), slice(gram, n + 1))
    least &= ~bits
    least |= np.arange(grams, dtype=np.uint64)
    inside, width = length - gram + 1, 1
    while 2 * width <= inside:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < inside:
        least = np.minimum(least[:width - inside], least[inside - width:])
    starts = np.flatnonzero(owner[:n - length + 1] == owner[length - 1:])
    if not len(starts):
        return Stretches(none, none, none)
    anchor = (least[starts] & bits).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    return Stretches(anchor[new], starts[new], starts[np.append(new[1:], len(starts)) - 1])
