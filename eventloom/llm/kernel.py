"""Vectorised text kernels over Arrow string columns.

Everything here works on one block of texts (a few MB) at a time: the UTF-8
bytes of the block's texts lie in one ``uint8`` array and ``bounds`` holds
``n + 1`` offsets into it. A word is a maximal run of bytes other than space,
tab, LF, VT, FF and CR; null texts count as empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that a block holds, unless one text alone is longer. Kernels that make
#: several 8-byte values per byte run fastest on blocks whose arrays stay in the cache.
BLOCK_BYTES = 2 << 20
SMALL_BLOCK = 64 << 10
#: Bytes from which on a word's hash is a digest.
LONG_WORD = 128

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_rng = np.random.default_rng(20240607)
_BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15  # odd, hence invertible modulo 2**64
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[:1] = 1
    out[1:] = np.uint64(base)
    return np.multiply.accumulate(out, out=out)


_POWERS: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = _POWERS[base] = _powers(base, max(n, 1 << 16))
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser on 64-bit values (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds) of a string or binary column without copying; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        empty = pa.scalar(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "", type=column.type)
        column = column.fill_null(empty)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def blocks(column: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Cut a column into (rows, bytes, bounds) of at most ``block_bytes``; one longer text is a block."""
    data, bounds = utf8(column)
    n, first = len(bounds) - 1, 0
    while first < n:
        last = int(np.searchsorted(bounds, bounds[first] + block_bytes, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield slice(first, last), data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
        first = last


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


@dataclass
class Words:
    start: np.ndarray  # byte offset of each word in the block
    end: np.ndarray
    first: np.ndarray  # n + 1 offsets into the words, by text

    @property
    def per_text(self) -> np.ndarray:
        return np.diff(self.first)


def words(data: np.ndarray, bounds: np.ndarray) -> Words:
    """Word positions of a block."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return Words(z, z, np.zeros(len(bounds), np.int64))
    inside = ~_SPACE[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    edges = bounds[:-1][bounds[:-1] < len(data)]
    opens[edges] = inside[edges]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    ends = bounds[1:][bounds[1:] > 0] - 1
    closes[ends] = inside[ends]
    start = np.flatnonzero(opens)
    return Words(start, np.flatnonzero(closes) + 1, np.searchsorted(start, bounds))


def inverse_powers(n: int) -> np.ndarray:
    """Factors that make prefix-hash differences independent of their place."""
    return _power_table(_BASE_INVERSE, n)


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """H with H[j] - H[i] = sum of code(byte) * BASE**position over [i, j), modulo 2**64."""
    out = np.empty(len(data) + 1, dtype=np.uint64)
    out[0] = 0
    np.cumsum(_BYTE_CODE[data] * _power_table(_BASE, len(data)), dtype=np.uint64, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes [start, end), independent of their place in the block."""
    inverse = _power_table(_BASE_INVERSE, len(prefix))
    return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[Words, np.ndarray]:
    """The words of a block and 64-bit hashes of them.

    A polynomial modulo 2**64 has collisions by construction between words of 1,024 bytes
    and more, whatever its base; words of ``LONG_WORD`` bytes and more get a BLAKE2 digest.
    """
    w = words(data, bounds)
    hashes = span_hash(prefix_hash(data), w.start, w.end)
    for i in np.flatnonzero(w.end - w.start >= LONG_WORD).tolist():
        hashes[i] = int.from_bytes(hashlib.blake2b(data[w.start[i] : w.end[i]].tobytes(), digest_size=8).digest(), "little")
    return w, hashes


def shingles(data: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, hash) of every distinct shingle of ``size`` words after lower-casing A-Z.

    A text with fewer words has its whole sequence as its one shingle; a text
    without words has none. Rows are ordered by text, then hash.
    """
    w, h = word_hashes(lower_ascii(data), bounds)
    count = w.per_text
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    odd = [np.uint64(pow(0xC2B2AE3D27D4EB4F, i + 1, 1 << 64) | 1) for i in range(size)]
    runs = np.where(count >= size, count - size + 1, (count > 0).astype(count.dtype))
    bound = np.concatenate([[0], np.cumsum(runs)])
    at = ragged(w.first[:-1], runs)
    h = mix(h)
    got = np.zeros(len(at), np.uint64)
    for i in range(size):
        got += h[np.minimum(at + i, len(h) - 1)] * odd[i]
    for t in np.flatnonzero((count > 0) & (count < size)).tolist():
        got[bound[t]] = _sequence(h[w.first[t] : w.first[t + 1]].tolist())
    got = mix(got)
    for a, b in zip(bound[:-1].tolist(), bound[1:].tolist()):
        got[a:b].sort()
    text = np.repeat(np.arange(len(count)), runs)
    keep = np.ones(len(got), bool)
    keep[1:] = (text[1:] != text[:-1]) | (got[1:] != got[:-1])
    return text[keep], got[keep]


def _sequence(hashes: list[int]) -> int:
    value = 0x5851F42D4C957F2D + len(hashes)
    for h in hashes:
        value = ((value ^ (value >> 29)) * 0x9FB21C651E98DF25 + h) & (2**64 - 1)
    return value


def ragged(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indices of the runs [first[i], first[i] + length[i]), one after the other."""
    total = int(length.sum())
    return np.repeat(first - (np.cumsum(length) - length), length) + np.arange(total)
