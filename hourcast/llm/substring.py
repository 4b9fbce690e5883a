"""Substring dedup: remove words covered by word windows that occur more than once.

Method: count-min prefilter, then exact grouping of what it leaves.

1. Every task hashes the windows of its texts.  A window is represented in the
   sketch by its *anchor*, the smallest hash among the shorter word runs inside
   it; equal windows have equal anchors at equal places, so the number of anchor
   occurrences is at least the number of window occurrences.  Consecutive windows
   mostly share one anchor, so a sketch row gets about a tenth of the insertions.
   The tasks' sparse sketches are merged per slice of the cell range.
2. The merged sketch ("cell seen at least twice", one bit per cell, of a fixed
   size) goes to all tasks.  Only windows whose anchor is estimated repeated in
   every sketch row are grouped, by a 96-bit hash of their words.  The estimate
   never undercounts, so no repeated window is lost; a full sketch only lets more
   windows through to the exact step.

Windows repeated within one task are settled there and stand for one row in the
shuffle, so a passage held by a third of all documents costs one row per task.

Defined results: a null text has no words; texts shorter than a window keep all
their words; two equal rows repeat each other (their windows are removed from
both); an empty table gives an empty table; a null ``doc_id`` is an ordinary
value.  All columns of the input are kept, and the added ones replace input
columns of the same name (``n_words``, ``n_removed``, ``kept_text``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourcast.llm import _words as W
from hourcast.llm._frames import aside, without

WINDOW_WORDS = 35
ANCHOR_WORDS = 16
SLICE_BITS = 20
MIN_WIDTH_BITS, MAX_WIDTH_BITS = 20, 29
#: Windows held by a task before it settles local repeats and passes them on.
FLUSH_WINDOWS = 500_000
#: Count of a run of windows that its task has found repeated.
SETTLED = -1

_ROW, _CRC = "__row_id", "__row_crc"


def sketch_width_bits(spark: SparkSession, docs: DataFrame, text: str) -> int:
    """Cells per sketch row: about one per eight bytes of text, within fixed bounds."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return min(MAX_WIDTH_BITS, max(MIN_WIDTH_BITS, math.ceil(math.log2(size / 8 + 1))))


def _cells(anchors: np.ndarray, bits: int) -> list[np.ndarray]:
    mask = W.U64((1 << bits) - 1)
    return [(anchors & mask).astype(np.int64), ((anchors >> W.U64(64 - bits)) & mask).astype(np.int64)]


class _Windows:
    """Windows of a slice of texts: anchors (value per window) and validity."""

    def __init__(self, column: pa.Array, window: int):
        self.words = words = W.Words(column)
        self.hash = h = words.hashes()
        n = len(h)
        gram = min(ANCHOR_WORDS, window)
        span = window - gram + 1
        self.valid = np.flatnonzero(W.run_starts(words.bounds, window, n))
        if not len(self.valid):
            self.anchor = self.selected = np.zeros(0, W.U64)
            return
        grams = W.run_hashes(h, gram)
        least = W.slide(grams, span, np.minimum)          # one per window position
        self.anchor = least[self.valid]
        # a gram is counted if it is the smallest of some window that covers it
        shown = np.zeros(len(least), W.U64)
        shown[self.valid] = self.anchor
        edge = np.zeros(span - 1, W.U64)
        cover = W.slide(np.concatenate([edge, shown, edge]), span, np.maximum)
        self.selected = grams[cover == grams]


def _sketch(window: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush():
            anchors = np.concatenate(held)
            held.clear()
            per_slice = 1 << min(SLICE_BITS, bits)
            for row, cells in enumerate(_cells(anchors, bits)):
                cells, counts = np.unique(cells, return_counts=True)
                counts = np.minimum(counts, 2).astype(np.uint8)
                parts = cells // per_slice
                cut = np.flatnonzero(np.diff(parts)) + 1
                lo = np.concatenate([[0], cut])
                hi = np.concatenate([cut, [len(cells)]])
                base = row << max(0, bits - SLICE_BITS)
                yield pa.RecordBatch.from_pydict({
                    "slice": pa.array([base + int(parts[a]) for a in lo], pa.int32()),
                    "cells": pa.array([(cells[a:b] % per_slice).astype(np.uint32).tobytes()
                                       for a, b in zip(lo, hi)], pa.binary()),
                    "counts": pa.array([counts[a:b].tobytes() for a, b in zip(lo, hi)], pa.binary())})

        for batch in batches:
            for part in W.slices(batch):
                held.append(_Windows(part.column(part.schema.get_field_index("text")), window).selected)
                if sum(map(len, held)) > 4 * FLUSH_WINDOWS:
                    yield from flush()
        if sum(map(len, held)):
            yield from flush()
    return run


def _merge(bits: int):
    per_slice = 1 << min(SLICE_BITS, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, cells, counts in zip(*(batch.column(i).to_pylist() for i in range(3))):
                seen = total.setdefault(s, np.zeros(per_slice, np.uint8))
                at = np.frombuffer(cells, np.uint32)
                seen[at] = np.minimum(seen[at] + np.frombuffer(counts, np.uint8), 2)
        for s, seen in total.items():
            yield pa.RecordBatch.from_pydict({
                "slice": pa.array([s], pa.int32()),
                "repeated": pa.array([np.packbits(seen >= 2, bitorder="little").tobytes()], pa.binary())})
    return run


def repeated_sketch(docs: DataFrame, text: str, window: int, bits: int) -> np.ndarray:
    """Merged sketch as bits, one row of cells after the other; ``2 * 2**bits / 8`` bytes."""
    sparse = docs.select(F.col(text).alias("text")).mapInArrow(
        _sketch(window, bits), "slice int, cells binary, counts binary")
    merged = sparse.repartition("slice").mapInArrow(_merge(bits), "slice int, repeated binary")
    out = np.zeros((2 << bits) // 8, np.uint8)
    size = (1 << min(SLICE_BITS, bits)) // 8
    for row in merged.toLocalIterator():
        out[row["slice"] * size:(row["slice"] + 1) * size] = np.frombuffer(row["repeated"], np.uint8)
    return out


def _candidates(window: int, bits: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = shared.value
        held: list[tuple] = []

        def flush():
            h1, h2, row, crc, pos = (np.concatenate(x) for x in zip(*held))
            held.clear()
            order = np.lexsort((h2, h1))
            h1, h2, row, crc, pos = (x[order] for x in (h1, h2, row, crc, pos))
            new = np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
            first = np.flatnonzero(new)
            n = np.diff(np.concatenate([first, [len(h1)]]))
            again = np.repeat(n > 1, n)
            # one row per distinct window, to be counted over all tasks
            yield _batch(h1[first], h2[first], row[first], crc[first], pos[first], pos[first] + 1, n)
            if again.any():
                # runs of windows known to repeat: settled, one row per run
                row, crc, pos = row[again], crc[again], pos[again]
                order = np.lexsort((pos, crc, row))
                row, crc, pos = (x[order] for x in (row, crc, pos))
                same = (row[1:] == row[:-1]) & (crc[1:] == crc[:-1])
                fresh = np.concatenate([[True], ~(same & (pos[1:] - pos[:-1] <= 1))])
                a = np.flatnonzero(fresh)
                b = np.concatenate([a[1:], [len(pos)]]) - 1
                fill = W.mix(row[a].astype(W.U64) * W.U64(31) + crc[a].astype(W.U64) * W.U64(17)
                             + pos[a].astype(W.U64))
                yield _batch(fill, fill >> W.U64(32), row[a], crc[a], pos[a], pos[b] + 1,
                             np.full(len(a), SETTLED))

        size = 0
        for batch in batches:
            for part in W.slices(batch):
                found = _Windows(part.column(part.schema.get_field_index("text")), window)
                if not len(found.valid):
                    continue
                keep = np.ones(len(found.valid), bool)
                for r, cells in enumerate(_cells(found.anchor, bits)):
                    cells += r << bits
                    keep &= (sketch[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1 == 1
                at = found.valid[keep]
                if not len(at):
                    continue
                doc = np.searchsorted(found.words.bounds, at, side="right") - 1
                row = part.column(part.schema.get_field_index(_ROW)).to_numpy(zero_copy_only=False)[doc]
                crc = part.column(part.schema.get_field_index(_CRC)).to_numpy(zero_copy_only=False)[doc]
                held.append((W.run_hashes(found.hash, window)[at],
                             W.run_hashes(found.hash, window, W.WORDS_2)[at] >> W.U64(32),
                             row, crc, (at - found.words.bounds[doc]).astype(np.int64)))
                size += len(at)
                if size > FLUSH_WINDOWS:
                    yield from flush()
                    size = 0
        if held:
            yield from flush()

    def _batch(h1, h2, row, crc, first, last, n):
        return pa.RecordBatch.from_pydict({
            "h1": pa.array(h1.view(np.int64)), "h2": pa.array(h2.astype(np.uint32).view(np.int32)),
            _ROW: pa.array(row, pa.int64()), _CRC: pa.array(crc, pa.int64()),
            "span": pa.array(first << 32 | last), "n": pa.array(n.astype(np.int32))})
    return run


_CANDIDATES = f"h1 long, h2 int, {_ROW} long, {_CRC} long, span long, n int"


def repeated_windows(spark: SparkSession, docs: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """Runs of window starts that occur more than once, per row key: ``span`` is
    ``first << 32 | last`` (the last one exclusive).

    ``docs`` has the columns ``__row_id``, ``__row_crc`` and ``text``.
    """
    bits = sketch_width_bits(spark, docs, "text")
    shared = spark.sparkContext.broadcast(repeated_sketch(docs, "text", window, bits))
    found = docs.mapInArrow(_candidates(window, bits, shared), _CANDIDATES)
    everywhere = Window.partitionBy("h1", "h2")
    settled = F.col("n") == SETTLED
    total = F.when(settled, F.lit(2)).otherwise(F.sum("n").over(everywhere))
    return (found.withColumn("total", total)
            .filter((F.col("total") > 1) & (settled | (F.col("n") == 1)))
            .select(_ROW, _CRC, "span"))


def _cut(names: list[str], text: str, window: int):
    """Remove the covered words of each text; adds n_words, n_removed, kept_text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, text):
                field = part.schema.get_field_index
                words = W.Words(part.column(field(text)))
                n = len(words.starts)
                gone = np.zeros(n + 1, np.int64)
                spans = part.column(field("__spans"))
                span = spans.flatten().to_numpy(zero_copy_only=False)
                doc = np.repeat(np.arange(len(spans)), spans.value_lengths().to_numpy(zero_copy_only=False))
                np.add.at(gone, words.bounds[:-1][doc] + (span >> 32), 1)
                np.add.at(gone, words.bounds[:-1][doc] + (span & 0xFFFFFFFF) + window - 1, -1)
                gone = np.cumsum(gone[:-1]) > 0 if n else np.zeros(0, bool)
                kept = ~gone
                removed = np.concatenate([[0], np.cumsum(gone)])
                removed = removed[words.bounds[1:]] - removed[words.bounds[:-1]]
                out, off = join_words(words, kept)
                columns = [part.column(field(x)) for x in names]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(words.counts.astype(np.int64)), pa.array(removed.astype(np.int64)),
                     W.strings(out, off)], [*names, "n_words", "n_removed", "kept_text"])
    return run


def join_words(words: W.Words, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kept words of every text joined by one space, as (bytes, offsets)."""
    data = words.data
    n_docs = len(words.bounds) - 1
    at = np.flatnonzero(kept)
    if not len(at):
        return np.zeros(0, np.uint8), np.zeros(n_docs + 1, np.int64)
    doc = np.searchsorted(words.bounds, at, side="right") - 1
    follows = np.concatenate([doc[1:] == doc[:-1], [False]])
    start, end = words.starts[at], words.ends[at]
    steps = np.zeros(len(data) + 2, np.int8)
    steps[start] += 1
    # a kept word with a later kept word keeps one separator byte behind it
    np.add.at(steps, end + follows, -1)
    mask = np.cumsum(steps[:len(data)], dtype=np.int8) > 0
    out = data.copy()
    out[end[follows]] = 0x20
    out = out[mask]
    size = np.bincount(doc, weights=end - start + follows, minlength=n_docs).astype(np.int64)
    return out, np.concatenate([[0], np.cumsum(size)])


def remove_repeats(spark: SparkSession, docs: DataFrame, text: str = "text", key: str = "doc_id",
                   window: int = WINDOW_WORDS) -> DataFrame:
    """All rows and columns of ``docs`` with ``n_words``, ``n_removed`` and ``kept_text``
    (the words outside repeated windows, joined by one space)."""
    W.bounded_batches(spark)
    docs, back = aside(docs, "spans", but=(text, key))
    base = without(docs, "n_words", "n_removed", "kept_text")
    # a row's key, never null: its id and its text's crc32; without an id 0 and a 62-bit
    # hash of the text, which no crc32 equals
    id_, whole = F.col(key).cast("long"), F.coalesce(F.col(text), F.lit(""))
    row_key = {_ROW: F.coalesce(id_, F.lit(0)),
               _CRC: F.when(id_.isNull(), F.xxhash64(whole).bitwiseOR(F.lit(1 << 62)))
               .otherwise(F.crc32(whole.cast("binary")))}
    keyed = base.select(*[c.alias(n) for n, c in row_key.items()],
                        F.coalesce(F.col(text), F.lit("")).alias("text"))
    marks = repeated_windows(spark, keyed, window).groupBy(_ROW, _CRC).agg(
        F.collect_set("span").alias("spans"))
    names = base.columns
    joined = base.withColumns(row_key).join(marks, [_ROW, _CRC], "left")
    ready = joined.select(*names, F.coalesce("spans", F.array().cast("array<long>")).alias("__spans"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    return ready.mapInArrow(_cut(names, text, window),
                            f"{schema}, n_words long, n_removed long, kept_text string").transform(back)
