"""Word hashes of whole text batches in numpy.

A batch of Arrow strings is one UTF-8 buffer. Words are runs of bytes outside
``[\\x20\\x09-\\x0D]``; a word's hash is a polynomial over a random byte table,
taken from prefix sums modulo 2**64 and mixed, so no Python object is made per
word and words of any length cost the same per byte.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_rng = np.random.Generator(np.random.PCG64(20240229))
_TABLE = _rng.integers(1, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(1, 2 ** 62)) * 4 + 1  # odd, so it has an inverse modulo 2**64
_INV = pow(_BASE, -1, 2 ** 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TABLE_LOWER = _TABLE[_LOWER]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True

#: text bytes handled at once: bounds the scratch arrays (about 60 bytes each)
CHUNK_BYTES = 4 << 20

_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n, grown by doubling and kept."""
    have = _powers.get("p")
    if have is None or len(have) < n:
        size = 1 << max(16, int(n).bit_length())
        for name, base in (("p", _BASE), ("q", _INV)):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            _powers[name] = np.cumprod(a, dtype=np.uint64)
    return _powers["p"], _powers["q"]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def combine(parts: list[np.ndarray]) -> np.ndarray:
    """One hash for aligned sequences of hashes; order matters."""
    h = parts[0]
    for p in parts[1:]:
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + p)
    return h


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES):
    """Row ranges [a, b) of about ``limit`` bytes (always a row at least)."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1
        b = min(n, max(a + 1, b))
        yield a, b
        a = b


def word_bounds(raw: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACE):
    """(start, end, row) of every word in order; ``between`` marks the bytes
    that part words."""
    space = np.empty(len(raw) + 2, bool)
    space[0] = space[-1] = True
    np.take(between, raw, out=space[1:-1])
    cut = np.zeros(len(raw) + 1, bool)
    cut[offsets] = True  # a text's end ends a word
    inside = ~space
    start = np.flatnonzero(inside[1:-1] & (space[:-2] | cut[:-1]))
    end = np.flatnonzero(inside[1:-1] & (space[2:] | cut[1:])) + 1
    row = np.searchsorted(offsets, start, "right") - 1
    return start, end, row


def prefix_sums(raw: np.ndarray, lower: bool = False) -> np.ndarray:
    """Polynomial prefix sums of the bytes, from which any span hashes."""
    p, _ = powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((_TABLE_LOWER if lower else _TABLE)[raw] * p[:len(raw)], out=sums[1:],
              dtype=np.uint64)
    return sums


def hash_between(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes start..end for every pair."""
    _, q = powers(len(sums))
    return mix((sums[end] - sums[start]) * q[start] + (end - start).astype(np.uint64))


def span_hash(raw: np.ndarray, start: np.ndarray, end: np.ndarray,
              lower: bool = False) -> np.ndarray:
    return hash_between(prefix_sums(raw, lower), start, end)


def word_hashes(raw: np.ndarray, offsets: np.ndarray, lower: bool = False):
    """(hash, row) of every word, in order."""
    start, end, row = word_bounds(raw, offsets)
    return span_hash(raw, start, end, lower), row


def row_starts(row: np.ndarray, n: int) -> np.ndarray:
    """First index of each of n rows in a sorted row array, and the end."""
    return np.searchsorted(row, np.arange(n + 1))


def signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)
