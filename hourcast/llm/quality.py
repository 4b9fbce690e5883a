"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of every whole text (:func:`statistics`) are computed on the executors in
vectorised passes over the text bytes.  The trees are fitted in numpy on a sample of
labelled rows of at most ``SAMPLE_ROWS`` (by id hash), by histograms
of binned statistics with logistic loss.  They are kept as flat arrays (feature,
threshold, left child, value per node), and scoring walks all rows of a batch down
one tree level at a time.

Defined results: a null text counts as empty, and empty texts get a score like any
other; repeated label rows of an id count with the lowest label; labels or ids that
are null are not learned from; without any row to learn from every score is 1, so
that nothing is rejected; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.llm import _words as W
from hourcast.llm._frames import fresh, quoted, without

SAMPLE_ROWS = 40_000
TREES, DEPTH, BINS, RATE, MIN_ROWS, L2 = 80, 4, 64, 0.15, 20, 1.0
THRESHOLD = 0.7

# --- statistics ------------------------------------------------------------------

#: Kinds of bytes: lower case, upper case, digit, line feed, other white space, sentence
#: punctuation, exclamation and question marks, other ASCII signs, control, non-ASCII.
_KINDS = 10
_KIND = np.full(256, 9, np.uint8)
for _b in range(128):
    _c = chr(_b)
    _KIND[_b] = (0 if _c.islower() else 1 if _c.isupper() else 2 if _c.isdigit() else 3 if _c == "\n"
                 else 4 if W.SPACE[_b] else 5 if _c in ".,;:'\"()-" else 6 if _c in "!?"
                 else 8 if _b < 32 or _b == 127 else 7)

NAMES = [*(f"share_{k}" for k in range(_KINDS)), "log_bytes", "log_words", "word_mean", "word_dev", "word_max",
         "distinct", "commonest", "same_as_last", "same_as_second_last", "upper_words", "signed_words",
         "digit_words", "words_per_line", "repeated_lines", "short_lines", "sentence_words"]


def _per_doc(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(doc, weights=values, minlength=n)


def statistics(column: pa.Array) -> np.ndarray:
    """One row of ``NAMES`` per text."""
    words = W.Words(column)
    data, off, n = words.data, words.offsets, len(words.offsets) - 1
    size = np.diff(off)
    kind = _KIND[data]
    byte_doc = np.repeat(np.arange(n), size)
    kinds = np.bincount(byte_doc * _KINDS + kind, minlength=n * _KINDS).reshape(n, _KINDS)
    out = [kinds / np.maximum(size, 1)[:, None]]
    count = words.counts
    some = np.maximum(count, 1)
    doc, hashes = words.doc_of_word(), words.hashes()
    length = (words.ends - words.starts).astype(float)
    mean = _per_doc(length, doc, n) / some
    square = _per_doc(length * length, doc, n) / some
    longest = np.zeros(n)
    np.maximum.at(longest, doc, length)
    # distinct words and the commonest: runs of equal (text, hash)
    key = np.sort(doc.astype(np.uint64) << W.U64(40) | hashes >> W.U64(24))
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, int)
    run_doc = (key[first] >> W.U64(40)).astype(np.int64)
    run = np.diff(np.concatenate([first, [len(key)]]))
    distinct = np.bincount(run_doc, minlength=n)
    commonest = np.zeros(n)
    np.maximum.at(commonest, run_doc, run)

    def same(lag):
        if len(hashes) <= lag:
            return np.zeros(n)
        hit = (hashes[lag:] == hashes[:-lag]) & (doc[lag:] == doc[:-lag])
        return np.bincount(doc[lag:][hit], minlength=n)

    head, tail = kind[words.starts], kind[words.ends - 1]
    before_tail = kind[np.maximum(words.ends - 2, words.starts)]
    upper = (head == 1) & (kind[np.minimum(words.starts + 1, words.ends - 1)] == 1) & (length > 1)
    signed = (tail >= 6) & (tail <= 8) & (before_tail >= 6) & (before_tail <= 8)
    # lines
    breaks = data == 0x0A
    first_byte = np.zeros(len(data) + 1, bool)
    first_byte[off[:-1]] = True
    begin = np.flatnonzero((first_byte[:-1] | np.concatenate([[False], breaks[:-1]])) & ~breaks) if len(data) \
        else np.zeros(0, np.int64)
    stop = np.flatnonzero(breaks | first_byte[1:] | (np.arange(1, len(data) + 1) == len(data))) if len(data) \
        else np.zeros(0, np.int64)
    end = stop[np.searchsorted(stop, begin)] + 1 if len(begin) else begin
    line_doc = np.searchsorted(off, begin, side="right") - 1
    lines = np.bincount(line_doc, minlength=n)
    word_line = np.searchsorted(begin, words.starts, side="right") - 1
    line_hash = np.zeros(len(begin), np.uint64)
    if len(begin):
        np.add.at(line_hash, word_line, hashes * (W.U64(2) * np.arange(len(hashes), dtype=np.uint64) + W.U64(1)
                                                  - W.U64(2) * np.searchsorted(words.starts, begin)[word_line].astype(np.uint64)))
    line_key = np.sort(line_doc.astype(np.uint64) << W.U64(40) | line_hash >> W.U64(24))
    new_line = np.concatenate([[True], line_key[1:] != line_key[:-1]]) if len(line_key) else np.zeros(0, bool)
    unlike = np.bincount((line_key[new_line] >> W.U64(40)).astype(np.int64), minlength=n)
    short = np.bincount(line_doc[(end - begin) < 40], minlength=n)
    some_lines = np.maximum(lines, 1)
    stops = np.bincount(doc[data[words.ends - 1] == ord(".")], minlength=n) if len(data) else np.zeros(n)
    out += [c[:, None] for c in (
        np.log1p(size), np.log1p(count), mean, np.sqrt(np.maximum(square - mean * mean, 0)), longest,
        distinct / some, commonest / some, same(1) / some, same(2) / some,
        np.bincount(doc[upper], minlength=n) / some, np.bincount(doc[signed], minlength=n) / some,
        np.bincount(doc[head == 2], minlength=n) / some, count / some_lines,
        1 - unlike / some_lines, short / some_lines, count / (stops + 1))]
    return np.hstack(out).astype(np.float32)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in W.slices(batch):
            x = statistics(part.column(2))
            values = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), values], ["doc_id", "y", "x"])


# --- trees -------------------------------------------------------------------------

@dataclass
class Trees:
    """All trees one after the other in flat arrays; a leaf has feature -1."""
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray           # the right child is the next node
    value: np.ndarray
    roots: np.ndarray
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(DEPTH):
                f = self.feature[node]
                step = x[rows, np.maximum(f, 0)] > self.threshold[node]
                node = np.where(f >= 0, self.left[node] + step, node)
            total += self.value[node]
        return 1 / (1 + np.exp(-total))


def fit_trees(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosted trees with logistic loss on histograms of ``BINS`` quantile bins."""
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
    bins = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], 1)
    flat = bins + np.arange(width) * BINS
    rate = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    base = float(np.log(rate / (1 - rate)))
    raw = np.full(n, base)
    feature, threshold, left, value, roots = [], [], [], [], []

    def node() -> int:
        feature.append(-1)
        threshold.append(0.0)
        left.append(0)
        value.append(0.0)
        return len(feature) - 1

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)
        roots.append(node())
        level = [(roots[-1], np.arange(n))]
        for depth in range(DEPTH + 1):
            below = []
            for at, rows in level:
                gs, hs = g[rows].sum(), h[rows].sum()
                value[at] = -RATE * gs / (hs + L2)
                if depth < DEPTH and len(rows) >= 2 * MIN_ROWS:
                    idx = flat[rows].ravel()
                    hist = [np.bincount(idx, weights=w, minlength=width * BINS).reshape(width, BINS).cumsum(1)
                            for w in (np.repeat(g[rows], width), np.repeat(h[rows], width), np.ones(len(idx)))]
                    gl, hl, cl = (a[:, :-1] for a in hist)
                    gain = gl ** 2 / (hl + L2) + (gs - gl) ** 2 / (hs - hl + L2) - gs ** 2 / (hs + L2)
                    gain[(cl < MIN_ROWS) | (len(rows) - cl < MIN_ROWS)] = -1
                    f, b = divmod(int(gain.argmax()), BINS - 1)
                    if gain[f, b] > 1e-3 and b < len(edges[f]):
                        right = bins[rows, f] > b
                        feature[at], threshold[at] = f, float(edges[f][b])
                        left[at] = node()
                        node()
                        below += [(left[at], rows[~right]), (left[at] + 1, rows[right])]
                        continue
                raw[rows] += value[at]
            level = below
    return Trees(np.array(feature), np.array(threshold, np.float32), np.array(left), np.array(value),
                 np.array(roots), base)


# --- Spark ---------------------------------------------------------------------------

def id_remainder(key: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; -1 for a null id."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % modulus, F.lit(-1)).cast("int")


def bounded_sample(known: DataFrame, rows: int, key: str = "doc_id", bins: int = 10_000) -> DataFrame:
    """All of ``known``, one row per key, or of more than ``rows`` those in the first bins
    of a hash of the key that together hold ``rows`` at most."""
    cell = F.pmod(F.xxhash64(key), F.lit(bins))
    counts = sorted(map(tuple, known.groupBy(cell.alias("cell")).count().collect()))
    total, last = 0, -1
    for i, n in counts:
        if total + n > rows:
            break
        total, last = total + n, i
    return known.filter(cell <= last)


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, learn_from: Column, text: str = "text",
        key: str = "doc_id", label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Trees | None:
    """Trees learned from labelled rows that meet ``learn_from``, a condition on the
    column ``doc_id``; at most ``sample_rows`` of them.  Of documents with one id the
    smallest text stands for it.  None without any."""
    W.bounded_batches(spark)
    known = (labels.select(F.col(key).cast("long").alias("doc_id"), F.col(label).cast("double").alias("y"))
             .filter(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & learn_from)
             .groupBy("doc_id").agg(F.min("y").alias("y")))
    # the labels are chosen first, so that only their documents are measured; they are
    # sample_rows at most, so their table may be broadcast
    chosen = F.broadcast(bounded_sample(known, sample_rows))
    texts = (docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
             .join(chosen, "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")))
    sample = texts.select("doc_id", "y", "text").mapInArrow(_measured, "doc_id long, y double, x array<float>").toArrow()
    if not sample.num_rows:
        return None
    # trees must not depend on the order in which tasks end
    order = np.argsort(sample["doc_id"].to_numpy())
    x = sample["x"].combine_chunks().flatten().to_numpy().reshape(sample.num_rows, -1)
    return fit_trees(x[order], sample["y"].to_numpy()[order])


def _score(names: list[str], text: str, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for batch in batches:
            for part in W.slices(batch, text):
                x = statistics(part.column(part.schema.get_field_index(text)))
                score = trees.scores(x) if trees is not None else np.ones(len(x))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(part.schema.get_field_index(c)) for c in names), pa.array(score)],
                    [*names, "score"])
    return run


def score(spark: SparkSession, docs: DataFrame, trees: Trees | None, text: str = "text") -> DataFrame:
    """``docs`` with its columns and ``score``, 0 to 1, higher for better texts."""
    W.bounded_batches(spark)
    base = without(docs, "score")
    (source,) = fresh(docs, "source_text")
    shared = spark.sparkContext.broadcast(trees)
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in base.schema.fields)
    return docs.select(*[quoted(c) for c in base.columns], F.coalesce(F.col(text), F.lit("")).alias(source)).mapInArrow(
        _score(base.columns, source, shared), f"{schema}score double")
