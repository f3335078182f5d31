"""Elias-Fano coded increasing sequences, read in place from mapped files.

The low bits of each value are packed one after the other, the high part is in
unary: a one for each value, a zero after each high part's values. Vectorised
access selects ones; search finds a high part's values by selecting zeros and
bisects their low bits.
"""

from __future__ import annotations

import numpy as np

_BIT_AT = np.full((256, 8), 8, np.uint8)  # place of the r-th set bit of a byte
for _b in range(256):
    _set = [k for k in range(8) if _b >> k & 1]
    _BIT_AT[_b, :len(_set)] = _set
_PACK = 1 << 16  # values whose low bits are packed at once; a multiple of 64

_ONES, _TOPS = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
_M1, _M2, _M4 = (np.uint64(x) for x in (0x5555555555555555, 0x3333333333333333, 0x0F0F0F0F0F0F0F0F))


def encode(values: np.ndarray, universe: int) -> bytes:
    """``values`` (uint64) strictly increasing and below ``universe``, at most 2**63."""
    n = len(values)
    low = 0
    while n and universe >> low > n:
        low += 1
    high = (values >> np.uint64(low)).astype(np.int64)
    bits = np.zeros(-(-((int(high[-1]) if n else 0) + n + 2) // 64) * 64, bool)
    bits[high + np.arange(n)] = True
    words = np.packbits(bits, bitorder="little")
    lows = []
    for k in range(0, n if low else 0, _PACK):
        octets = np.ascontiguousarray(values[k:k + _PACK].astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :-(-low // 8)]
        lows.append(np.packbits(np.unpackbits(octets, axis=1, bitorder="little")[:, :low].ravel(), bitorder="little"))
    lows = b"".join(x.tobytes() for x in lows)
    size = -(-len(lows) // 8) + 1  # a word more, as a value may be read from two
    head = np.array([n, low, len(words)], np.int64)
    return head.tobytes() + words.tobytes() + lows.ljust(8 * size, b"\0")


def _select(x: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Place of the ``r``-th set bit, from 0, of each 64-bit number."""
    s = x - ((x >> np.uint64(1)) & _M1)
    s = (s & _M2) + ((s >> np.uint64(2)) & _M2)
    upto = ((s + (s >> np.uint64(4))) & _M4) * _ONES  # byte j: bits set in bytes 0 to j
    r = r.astype(np.uint64)
    o = np.bitwise_count((r * _ONES | _TOPS) - upto & _TOPS).astype(np.uint64)
    at = o << np.uint64(3)
    r = r - ((upto << np.uint64(8)) >> at & np.uint64(255))
    return (at + _BIT_AT[(x >> at & np.uint64(255)).astype(np.intp), r.astype(np.intp)]).astype(np.int64)


class Sequence:
    """A coded sequence at ``at`` in a buffer; ``end`` is where it ends."""

    def __init__(self, buf, at: int = 0):
        n, low, size = np.frombuffer(buf, np.int64, 3, at).tolist()
        at += 24
        self.n, self.low = n, low
        self.words = np.frombuffer(buf, np.uint64, size // 8, at)
        many = -(-(-(-(n * low) // 8)) // 8) + 1
        self.lows = np.frombuffer(buf, np.uint64, many, at + size)
        self.end = at + size + 8 * many
        self.ones = np.cumsum(np.bitwise_count(self.words), dtype=np.int64)
        self.zeros = 64 * np.arange(1, len(self.words) + 1) - self.ones

    def _upto(self, high: np.ndarray) -> np.ndarray:
        """How many values have a high part of at most ``high``."""
        inside = high < self.zeros[-1]
        k = np.where(inside, high, 0)
        w = np.searchsorted(self.zeros, k, "right")
        at = w * 64 + _select(~self.words[w], k - np.where(w > 0, self.zeros[w - 1], 0))
        return np.where(inside, np.minimum(at - k, self.n), self.n)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(i), np.uint64)
        bit = i * self.low
        w, off = bit >> 6, (bit & 63).astype(np.uint64)
        both = self.lows[w] >> off | self.lows[w + 1] << np.uint64(1) << (np.uint64(63) - off)
        return both & np.uint64((1 << self.low) - 1)

    def at(self, i: np.ndarray) -> np.ndarray:
        """The values (uint64) at places ``i``, which are below n."""
        if not len(i):
            return np.empty(0, np.uint64)
        w = np.searchsorted(self.ones, i, "right")
        one = w * 64 + _select(self.words[w], i - np.where(w > 0, self.ones[w - 1], 0))
        return (one - i).astype(np.uint64) << np.uint64(self.low) | self._low(i)

    def find(self, values: np.ndarray, begin=0, stop=None) -> np.ndarray:
        """Places of ``values`` (uint64) from ``begin`` to before ``stop``, if
        given one each for every value; -1 where one is not there."""
        if not self.n or not len(values):
            return np.full(len(values), -1, np.int64)
        # a number beyond the sequence, however large, has a high part beyond its last
        high = np.minimum(values >> np.uint64(self.low), np.uint64(1 << 62)).astype(np.int64)
        want = values & np.uint64((1 << self.low) - 1)
        hi = np.minimum(self._upto(high), self.n if stop is None else stop)
        lo = np.maximum(np.where(high > 0, self._upto(np.maximum(high - 1, 0)), 0), begin)
        end = hi.copy()
        live = np.flatnonzero(lo < hi)
        while len(live):
            mid = (lo[live] + hi[live]) // 2
            less = self._low(mid) < want[live]
            lo[live[less]] = mid[less] + 1
            hi[live[~less]] = mid[~less]
            live = live[lo[live] < hi[live]]
        ok = lo < end
        ok[ok] = self._low(lo[ok]) == want[ok]
        return np.where(ok, lo, -1)
