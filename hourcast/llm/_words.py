"""Vectorised words and shingle hashes over Arrow string columns.

Everything works on the flat UTF-8 buffer of a column, so a batch costs a fixed
number of numpy passes whatever the number of texts.  A word is a run of bytes
other than space, tab, newline, vertical tab, form feed and carriage return.
Batches are cut into slices of a few MB (:func:`slices`) so that the temporary
arrays stay bounded; one text longer than a slice is a slice of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
SLICE_BYTES = 1 << 20
#: Bytes hashed at a time, unless one span is longer.
SPAN_BYTES = 1 << 19

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_rng = np.random.default_rng(20240131)
BYTE_VALUES = _rng.integers(1, 2 ** 63, 256, dtype=np.uint64)
LOWER_VALUES = BYTE_VALUES.copy()
LOWER_VALUES[ord("A"):ord("Z") + 1] = BYTE_VALUES[ord("a"):ord("z") + 1]


def bounded_batches(spark) -> None:
    """Bound what a Python worker is handed at once, by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


class Powers:
    """Powers of an odd multiplier modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base | 1, pow(base | 1, -1, 2 ** 64)
        self.up = self.down = np.ones(1, U64)

    def upto(self, n: int):
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, b in (("up", self.base), ("down", self.inverse)):
                a = np.full(size, b, U64)
                a[0] = 1
                setattr(self, name, np.multiply.accumulate(a))
        return self.up, self.down


BYTES = Powers(0x9E3779B97F4A7C15)
WORDS = Powers(0xC2B2AE3D27D4EB4F)
WORDS_2 = Powers(0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (in place)."""
    h ^= h >> U64(32)
    h *= U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(29)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(32)
    return h


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or
                                  pa.types.is_large_binary(column.type) else "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64 if large else np.int32)
    off = off[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, name: str = "text", limit: int = SLICE_BYTES):
    """Cut a batch into parts of at most ``limit`` text bytes (one row at least)."""
    _, off = flat(batch.column(batch.schema.get_field_index(name)))
    start, n = 0, batch.num_rows
    while start < n:
        stop = int(np.searchsorted(off, off[start] + limit, side="right")) - 1
        stop = min(n, max(stop, start + 1))
        yield batch.slice(start, stop - start)
        start = stop


class Words:
    """Word boundaries of a column: ``starts``/``ends`` are byte offsets into
    ``data``; words of text d are ``bounds[d]`` up to ``bounds[d + 1]``."""

    def __init__(self, column: pa.Array):
        self.data, self.offsets = flat(column)
        word = ~SPACE[self.data]
        first, last = word.copy(), word.copy()
        if len(word):
            first[1:] &= ~word[:-1]
            last[:-1] &= ~word[1:]
            begin = self.offsets[:-1][self.offsets[:-1] < self.offsets[1:]]
            end = self.offsets[1:][self.offsets[:-1] < self.offsets[1:]] - 1
            first[begin] = word[begin]
            last[end] = word[end]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.starts, self.offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """64-bit hash of every word (``lower``: of its A-Z lower-cased form)."""
        return span_hashes(self.data, self.starts, self.ends, LOWER_VALUES if lower else BYTE_VALUES)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                values: np.ndarray = BYTE_VALUES) -> np.ndarray:
    """64-bit hash of every byte span; spans are in ascending order."""
    out = np.empty(len(starts), U64)
    i = 0
    while i < len(out):
        stop = int(np.searchsorted(ends, starts[i] + SPAN_BYTES, side="right"))
        stop = max(stop, i + 1)
        a, b = starts[i], ends[stop - 1]
        up, down = BYTES.upto(b - a)
        sums = np.empty(b - a + 1, U64)
        sums[0] = 0
        np.cumsum(values[data[a:b]] * up[:b - a], out=sums[1:])
        s, e = starts[i:stop] - a, ends[i:stop] - a
        out[i:stop] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(U64))
        i = stop
    return out


def run_hashes(words: np.ndarray, k: int, powers: Powers = WORDS) -> np.ndarray:
    """Hash of every run of ``k`` consecutive word hashes (whatever text they are in)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    up, down = powers.upto(len(words))
    sums = np.empty(len(words) + 1, U64)
    sums[0] = 0
    np.cumsum(words * up[:len(words)], out=sums[1:])
    return mix((sums[k:] - sums[:n]) * down[:n])


def run_starts(bounds: np.ndarray, k: int, n_words: int) -> np.ndarray:
    """Mask over word positions: a run of ``k`` words starts here within one text."""
    ok = np.zeros(max(n_words, 0), bool)
    if n_words:
        room = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(n_words)
        ok = room >= k
    return ok


def slide(values: np.ndarray, width: int, op) -> np.ndarray:
    """Sliding minimum or maximum (``op``) over ``width`` consecutive values."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = op(out[:-step], out[step:]) if len(out) > step else out[:0]
        have += step
    return out


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A string column from flat UTF-8 bytes and offsets."""
    return pa.Array.from_buffers(
        pa.large_string(), len(offsets) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)),
         pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.string())
