"""Vectorised text helpers for Arrow batches: bytes, words and word hashes as numpy arrays.

All functions work on whole texts. A batch is cut into runs of documents of about ``CHUNK_BYTES``, so that
the arrays of one run stay small; a document longer than that is a run of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_RANDOM = np.random.default_rng(20240117)
BYTE_VALUES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2**64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[list(SPACE_BYTES)] = False

#: Digits, letters and everything beyond ASCII.
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[0x30:0x3A] = True
ALPHANUMERIC[0x41:0x5B] = True
ALPHANUMERIC[0x61:0x7B] = True
ALPHANUMERIC[0x80:] = True


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts of a column in a row, and n + 1 offsets. A null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def runs(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents, each of at most ``limit`` bytes or a single document."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray):
    """Start, end and document number of every word, a longest run of bytes with ``inside[byte]``."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    member = inside[data]
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = member[:-1]
    edges = offsets[:-1][offsets[:-1] < n]
    before[edges] = False
    starts = np.flatnonzero(member & ~before)
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = member[1:]
    after[edges[edges > 0] - 1] = False
    ends = np.flatnonzero(member & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


class Powers:
    """Powers of the base and of its inverse modulo 2^64, kept for later runs."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = max(n + 1, CHUNK_BYTES + 1)
            up, down = (np.full(size, x, dtype=np.uint64) for x in (BASE, INVERSE))
            up[0] = down[0] = 1
            up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
            if size > 4 * CHUNK_BYTES:
                return up, down
            self.up, self.down = up, down
        return self.up, self.down


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """A 64-bit hash of ``data[start:end]`` for each span: differences of one running polynomial."""
    up, down = powers.to(len(data))
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUES[data] * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def hash_of(word: bytes) -> int:
    """``span_hashes`` of one word, for tables that are built word by word."""
    total, power = 0, 1
    for byte in word:
        total = (total + int(BYTE_VALUES[byte]) * power) % 2**64
        power = power * BASE % 2**64
    return int(mix(np.array([(total + len(word)) % 2**64], dtype=np.uint64))[0])


def join_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all windows of ``k`` consecutive word hashes."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = hashes[:n].copy()
    for j in range(1, k):
        total = mix(total * np.uint64(BASE) + hashes[j : j + n])
    return total
