"""Numpy views of the text column of an Arrow batch: bytes, word spans and span hashes.

The kernels of this subpackage work on whole batches: a batch's texts are one byte array with offsets, words are spans in it,
and a span's hash comes from prefix polynomial hashes modulo 2**64, so no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that a kernel handles at once; one longer text is a slice of its own.
SLICE_BYTES = 2 << 20
SLICE_ROWS = 8_192
#: The same for the kernels that follow each other in the pipeline, whose Python workers live through all stages: a byte of text takes some
#: arrays of 8 bytes, and a worker keeps its largest size.
SMALL_SLICE_BYTES = 1 << 19


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 booleans, true within the inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low:high + 1] = True
    return table


#: Separators of the word pattern ``[^\x20\x09-\x0D]+``.
WHITE_SPACE = byte_set((0x20, 0x20), (0x09, 0x0D))
#: Separators of the word pattern ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``: all ASCII but digits and a-z.
NOT_ALNUM = byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
#: Maps A-Z to a-z and leaves every other byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES,
           rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``rows`` rows and ``limit`` bytes of text, or of one row."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        i = 0
        while i < len(ends):
            before = ends[i - 1] if i else 0
            j = min(i + rows, max(i + 1, int(np.searchsorted(ends, before + limit, "right"))))
            yield batch.slice(i, j - i)
            i = j


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and their n + 1 offsets; a null text is empty."""
    array = array.cast(pa.large_string())
    if array.null_count:
        array = pc.fill_null(array, "")
    _, offsets, data = array.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(array) + 1 + array.offset)[array.offset:]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every run of true cells; runs never cross texts."""
    first, last = inside.copy(), inside.copy()
    if len(inside):
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cuts = offsets[(offsets > 0) & (offsets < len(inside))]
        first[cuts] = inside[cuts]
        last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray):
    """Start, end and text number of every word."""
    return runs(~separators[data], offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the odd base and of its inverse modulo 2**64, as many as the texts so far needed; kept up to a few slices' length."""
    kept = _POWERS.get(base)
    if kept is None or len(kept[0]) < n:
        size = max(n, min(SLICE_BYTES + 1, 1 << (n - 1).bit_length()))
        made = []
        for factor in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            made.append(np.cumprod(steps, dtype=np.uint64))
        kept = (made[0], made[1])
        if size <= 4 * SLICE_BYTES:
            _POWERS[base] = kept
    return kept


@lru_cache(maxsize=8)
def _symbols(seed: int) -> tuple[int, np.ndarray]:
    rng = np.random.default_rng(seed)
    return int(rng.integers(1 << 62, dtype=np.uint64)) * 2 + 1, rng.integers(1 << 63, size=256, dtype=np.uint64)


class SpanHasher:
    """Prefix polynomial hashes of a byte or code point array; equal spans have equal hashes, wherever they stand."""

    def __init__(self, data: np.ndarray, seed: int = 1):
        base, symbols = _symbols(seed)
        powers, self.inverse = _powers(base, len(data) + 1)
        coded = symbols[data] if data.dtype == np.uint8 else mix(data.astype(np.uint64) + np.uint64(seed))
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(coded * powers[:len(data)], out=self.prefix[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.prefix[ends] - self.prefix[starts]) * self.inverse[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def windows(hashes: np.ndarray, owner: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first index of every run of ``width`` consecutive words of one text."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    made = np.zeros(n, np.uint64)
    for k in range(width):
        made = made * np.uint64(0x9FB21C651E98DF25) + hashes[k:k + n]
    whole = np.flatnonzero(owner[:n] == owner[width - 1:])
    return mix(made[whole]), whole


def bounds(owner: np.ndarray, n: int) -> np.ndarray:
    """For ascending owners 0 .. n - 1: n + 1 offsets of their runs."""
    return np.searchsorted(owner, np.arange(n + 1))


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of values[start:start + length] of all ranges."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


def strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans as Arrow strings; spans have to begin and end at characters."""
    lengths = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(gather(data, starts, lengths)))
