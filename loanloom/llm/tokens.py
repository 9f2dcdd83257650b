"""Word hashes of a whole Arrow column at once, straight from its UTF-8 bytes.

A word hash is a polynomial over the bytes of the word modulo 2^64, mixed with
the length.  Prefix sums give it for every word of a batch without a loop.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters that are worked on at once; a longer text is worked on alone.
CHUNK_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE_CODES = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64)


def space_bytes() -> np.ndarray:
    """Marks ASCII white space and control bytes."""
    flags = np.zeros(256, dtype=bool)
    flags[:33] = True
    flags[127] = True
    return flags


def punctuation_bytes() -> np.ndarray:
    """Marks every ASCII byte that is neither a letter nor a digit."""
    flags = np.ones(256, dtype=bool)
    flags[128:] = False
    for low, high in ((48, 58), (65, 91), (97, 123)):
        flags[low:high] = False
    return flags


SPACES, NON_WORD = space_bytes(), punctuation_bytes()


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniforms(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from hashes."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def slices(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts together hold about ``limit`` bytes at most."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first, total = 0, 0
    for i, n in enumerate(lengths):
        if total and total + n > limit:
            yield first, i
            first, total = i, 0
        total += n + 16
    if first < len(lengths):
        yield first, len(lengths)


def spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the first word of every row (with one more at the end)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~separators[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | cut[1:-1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return starts, stops, np.searchsorted(starts, offsets)


def sequence_hashes(values: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Hashes of stretches of a sequence of 64-bit values."""
    n = len(values)
    powers = np.ones(n + 1, dtype=np.uint64)
    powers[1:] = _BASE
    np.multiply.accumulate(powers, out=powers)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values * powers[:-1], out=sums[1:])
    inverse = np.ones(n + 1, dtype=np.uint64)
    inverse[1:] = _BASE_INVERSE
    np.multiply.accumulate(inverse, out=inverse)
    codes = (sums[stops] - sums[starts]) * inverse[starts]
    return mixed(codes ^ ((stops - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def span_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    return sequence_hashes(_BYTE_CODES[data], starts, stops)


def words(column: pa.Array, separators: np.ndarray = SPACES, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a column, and the first word of each row (with one more at the end)."""
    data, offsets = utf8(pc.utf8_lower(column) if lower else column)
    starts, stops, first = spans(data, offsets, separators)
    return span_hashes(data, starts, stops), first


def shingles(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``size`` words within each row; a row of fewer words has one run of them all."""
    counts = np.diff(first)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    begin = np.concatenate(([0], np.cumsum(runs)))
    row = np.repeat(np.arange(len(counts)), runs)
    at = first[:-1][row] + np.arange(begin[-1]) - begin[:-1][row]
    width = np.minimum(counts[row], size)
    out = np.zeros(len(at), dtype=np.uint64)
    for j in range(size):
        here = np.where(j < width, hashes[np.minimum(at + j, max(len(hashes) - 1, 0))] if len(hashes) else 0, np.uint64(0))
        out = out * np.uint64(0xC2B2AE3D27D4EB4F) + here.astype(np.uint64)
    return mixed(out + width.astype(np.uint64)), begin
