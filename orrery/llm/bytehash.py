"""Vectorised 64-bit hashes of many byte spans of one buffer.

A span's hash is sum((byte + 1) * M**-k) modulo 2**64 over its places k, taken
from running sums over the buffer, then mixed. Buffers are worked on in chunks,
so the tables of powers have a bounded size.
"""

from __future__ import annotations

import numpy as np
import xxhash

M = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
CHUNK = 1 << 19
LONG = 256  # words of more bytes have hashes of their own: long words can be made whose sums are equal
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """M**k and M**-k for k below n at least."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, CHUNK + 1)
        for name, base in (("up", M), ("down", pow(M, -1, 1 << 64))):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            _POWERS[name] = np.multiply.accumulate(a)
    return _POWERS["up"], _POWERS["down"]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def running(buf: np.ndarray) -> np.ndarray:
    """Running sums for ``spans``: one more than the bytes."""
    _, down = powers(len(buf) + 1)
    s = np.zeros(len(buf) + 1, np.uint64)
    terms = buf.astype(np.uint64)
    terms += np.uint64(1)
    terms *= down[:len(buf)]
    np.cumsum(terms, out=s[1:])
    return s


def spans(s: np.ndarray, lo, hi) -> np.ndarray:
    """Mixed hashes of the spans [lo, hi) of the buffer that ``s`` is of."""
    up, _ = powers(len(s))
    return mix((s[hi] - s[lo]) * up[lo])


def words(buf: np.ndarray, fold: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the maximal runs of bytes b with
    ``member[fold[b]]``; the hashes are of the folded bytes (of long words
    XXH64)."""
    out, at = [], 0
    while at < len(buf):
        size = CHUNK
        while True:
            b = fold[buf[at:at + size]]
            inside = member[b]
            if at + len(b) >= len(buf) or not inside[-1]:
                break
            gap = np.flatnonzero(~inside)
            if len(gap):  # ends at a gap: no word is cut
                b, inside = b[:gap[-1] + 1], inside[:gap[-1] + 1]
                break
            size *= 2
        edge = np.flatnonzero(np.diff(np.r_[False, inside, False].view(np.int8)))
        lo, hi = edge[::2], edge[1::2]
        h = spans(running(b), lo, hi)
        for k in np.flatnonzero(hi - lo > LONG).tolist():
            h[k] = xxhash.xxh64_intdigest(b[lo[k]:hi[k]].tobytes())
        out.append((lo + at, hi + at, h))
        at += len(b)
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out))


def lower_table() -> np.ndarray:
    """Bytes with A-Z lower-cased."""
    t = np.arange(256, dtype=np.uint8)
    t[0x41:0x5B] += 0x20
    return t
