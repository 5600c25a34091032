"""Words of whole Arrow batches as numpy arrays: bounds, hashes and hashes of word sequences.

Everything works on the UTF-8 bytes of many texts at once. Separators are ASCII, so that bytes can be told
apart without decoding. A null text counts as empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at a time; the arrays below take about forty times as much.
SLICE_BYTES = 2 << 20
LONG_WORD = 512

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True


def text_slices(column, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with at most ``limit`` bytes; a longer text is a run by itself."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def word_bounds(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text number) of each word; bounds are byte positions in ``data``."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~separator[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a fixed bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of each word's bytes: a polynomial over a seeded byte table, taken from running sums."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    base = int(mix(np.array([2 * seed + 1], np.uint64))[0]) | 5
    byte = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(byte[data] * _powers(base, len(data)), out=sums[1:])
    inverse = _powers(pow(base, -1, 1 << 64), len(data))
    h = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    for i in np.flatnonzero(ends - starts > LONG_WORD):  # such polynomials can meet on very long words
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8, key=seed.to_bytes(8, "little")).digest()
        h[i] = int.from_bytes(digest, "little")
    return h


def sequence_hashes(words: np.ndarray, n: int, seed: int = 1) -> np.ndarray:
    """A hash of each run of ``n`` consecutive words: entry i is of words i to i + n - 1."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    factors = _powers(int(mix(np.array([seed + 77], np.uint64))[0]) | 5, n + 1)[1:]
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out += words[k : k + len(out)] * factors[k]
    return mix(out)
