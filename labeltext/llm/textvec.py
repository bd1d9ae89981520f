"""Words and their hashes for a batch of texts, as numpy arrays.

A word is a run of bytes other than the six ASCII white-space characters, i.e.
``[^\\x20\\x09-\\x0D]+``. Word hashes are polynomials over the bytes, taken from
one running sum, so no Python object is made per word.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; one longer text is handled on its own. A worker holds
#: some hundred bytes for each of them, so steps that gain nothing by many texts take FEW_BYTES.
CHUNK_BYTES, FEW_BYTES = 1_000_000, 200_000

_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes that end a piece of a word: ASCII other than letters and digits.
_BREAK = np.ones(256, bool)
_BREAK[128:] = False
_BREAK[48:58] = _BREAK[65:91] = _BREAK[97:123] = False


def powers(base: int, n: int) -> np.ndarray:
    """``base ** (0 .. n)`` modulo 2**64."""
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Rolling:
    """Hashes of the slices ``[start, end)`` of one array of 64-bit values."""

    def __init__(self, values: np.ndarray, base: int = _BASE):
        n = len(values)
        known = sys.__dict__.setdefault("_word_hash_powers", {})  # of the process; not shipped with jobs
        up, down = known.get(base, (np.zeros(0), np.zeros(0)))
        if len(up) <= n:
            size = max(n, FEW_BYTES if n <= FEW_BYTES else CHUNK_BYTES)
            up, down = powers(base, size), powers(pow(base, -1, 1 << 64), size)
            if size <= CHUNK_BYTES:
                known[base] = (up, down)
        self.down = down
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * up[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


@dataclass
class Words:
    """Words of some consecutive rows of a batch, in order."""

    first: int  # the first row
    rows: int
    data: np.ndarray  # the bytes of these rows
    start: np.ndarray  # of each word within data
    end: np.ndarray
    bounds: np.ndarray  # words of row i: bounds[i] to bounds[i + 1]
    roll: Rolling

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.bounds))

    def hashes(self) -> np.ndarray:
        return self.roll.of(self.start, self.end)

    def prefixes(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Which words have at least ``n`` bytes, and the hashes of their first ``n``."""
        long = np.flatnonzero(self.end - self.start >= n)
        return long, self.roll.of(self.start[long], self.start[long] + n)


def words(texts: pa.Array, lower: bool = False, pieces: bool = False, chunk_bytes: int = CHUNK_BYTES) -> Iterator[Words]:
    """The words of ``texts`` (null: none), some rows of ``chunk_bytes`` together at a time.

    ``pieces`` also ends words at ASCII characters other than letters and digits.
    """
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    ends = _BREAK if pieces else _SPACE
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(at, at[first] + chunk_bytes, "right")) - 1)
        chunk, edges = data[at[first] : at[last]], at[first : last + 1] - at[first]
        if lower:
            chunk = _LOWER[chunk]
        inside = np.zeros(len(chunk) + 2, bool)
        inside[1:-1] = ~ends[chunk]
        inner = edges[(edges > 0) & (edges < len(chunk))]
        begins = inside[1:-1] & ~inside[:-2]
        begins[inner] = inside[1:-1][inner]
        stops = inside[1:-1] & ~inside[2:]
        stops[inner - 1] = inside[1:-1][inner - 1]
        start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        yield Words(
            first, last - first, chunk, start, end, np.searchsorted(start, edges),
            Rolling(chunk.astype(np.uint64) + np.uint64(1)),
        )
        first = last
