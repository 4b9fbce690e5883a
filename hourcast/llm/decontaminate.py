"""Benchmark decontamination by size-partitioned MinHash containment search.

A test item is contained in a document if at least ``THRESHOLD`` of the item's
distinct five-word shingles (A-Z lower-cased words) occur in the document.

Method:

1. The items' shingle hashes are merged into a filter of a fixed number of bits,
   which every task gets, however many items there are.
2. Each document with a filter hit is sketched by one-permutation MinHash: its
   shingle hashes fall into bins, and a bin's value is the smallest hash in it.
   Documents are partitioned by their number of shingles, and a partition of up to
   2**s shingles uses ``BINS_PER_SHINGLE * 2**s`` bins, so long documents keep as much
   of a short item as short ones do.
3. The bin values are joined with the items' shingles.  An item is a candidate for a
   document if they share ``SKETCH_SHARE`` of the shingles that a contained item must
   share.  A shared shingle is its bin's value with probability 0.88 or more, and an item
   of more than ``EXACT_SHINGLES`` shingles must share 27 or more: one that is contained
   is missed with probability below 1e-6.  For an item of fewer shingles, where the
   estimate is too coarse, every shared shingle makes a candidate, so none is missed.
4. Candidates are verified: the distinct shingles that a candidate pair shares, compared
   as texts and not as hashes, are counted for these pairs only.

An item of one to four words is a single shingle of all its words, looked for as such
a run of words; an item without words is in no document.

Documents and items are told apart by id and text hash until the end.

Defined results: null or empty texts contain nothing; equal texts under different ids
are separate items, and equal rows count once; one row per (document id, item id):
documents or items that share an id but not a text give the highest containment, of
equal ones that with the most shingles; null ids are ordinary values; empty tables
give an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.llm import _words as W
from hourcast.llm._frames import aside, written
from hourcast.llm.simhash import LOWER

SHINGLE_WORDS = 5
THRESHOLD = 0.8
FILTER_BITS = 25
BINS_PER_SHINGLE = 4
EXACT_SHINGLES = 32
SKETCH_SHARE = 0.5


def _runs(words: W.Words, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of every run of ``k`` words inside one text."""
    at = np.flatnonzero(W.run_starts(words.bounds, k, len(hashes)))
    return at, (W.run_hashes(hashes, k)[at] + W.U64(k) if len(at) else np.zeros(0, W.U64))


def _text(raw: bytes, words: W.Words, first: int, k: int) -> str:
    """The shingle of ``k`` words at a word position, as text."""
    piece = raw[words.starts[first]:words.ends[first + k - 1]]
    return b" ".join(piece.translate(LOWER).split()).decode()


def _item_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = W.Words(batch.column(2))
        hashes, raw = words.hashes(lower=True), words.data.tobytes()
        item, n_shingles, size, h, text = [], [], [], [], []
        for d, n in enumerate(words.counts):
            k = min(SHINGLE_WORDS, int(n))
            if not k:
                continue
            first = int(words.bounds[d])
            run = W.run_hashes(hashes[first:first + int(n)], k) + W.U64(k)
            seen = {_text(raw, words, first + i, k): int(x) for i, x in enumerate(run.view(np.int64))}
            text += seen.keys()
            h += seen.values()
            item += [d] * len(seen)
            n_shingles += [len(seen)] * len(seen)
            size += [k] * len(seen)
        take = pa.array(item, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(take), batch.column(1).take(take), pa.array(n_shingles, pa.int64()),
             pa.array(size, pa.int32()), pa.array(h, pa.int64()), pa.array(text, pa.string())],
            ["item_id", "item_hash", "n_shingles", "k", "h", "shingle"])


def item_shingles(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct shingles (item_id, item_hash, n_shingles, k, h, shingle) of every distinct item."""
    return (items.select(F.col(key).cast("long").alias("item_id"), _text_hash(F.col(text)).alias("item_hash"),
                         F.coalesce(F.col(text), F.lit("")).alias("t")).distinct()
            .mapInArrow(_item_shingles, "item_id long, item_hash long, n_shingles long, k int, h long, "
                        "shingle string"))


def _positions(h: np.ndarray) -> list[np.ndarray]:
    return [(h >> W.U64(64 - FILTER_BITS)).astype(np.int64),
            (h & W.U64((1 << FILTER_BITS) - 1)).astype(np.int64)]


def _filter_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, at in enumerate(_positions(batch.column(0).to_numpy().view(np.uint64))):
            at = at + (row << FILTER_BITS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at >> 5), pa.array(np.left_shift(np.int64(1), at & 31))], ["word", "bits"])


def item_filter(shingles: DataFrame) -> np.ndarray:
    """The items' filter: two rows of 2**FILTER_BITS bits, 8 MB in all."""
    merged = (shingles.select("h").mapInArrow(_filter_words, "word long, bits long")
              .groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow())
    out = np.zeros((2 << FILTER_BITS) >> 5, np.uint32)
    out[merged["word"].to_numpy()] = merged["bits"].to_numpy().astype(np.uint32)
    return out


def _bin_values(h: np.ndarray, n: int) -> np.ndarray:
    """Mask of the hashes that are the smallest of their bin."""
    bins = BINS_PER_SHINGLE << max(0, int(n - 1).bit_length())
    cell = ((h >> W.U64(20)) % W.U64(bins)).astype(np.int64)
    low = np.full(bins, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(low, cell, h)
    return h == low[cell]


def _hits(lengths: list[int], shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            for part in W.slices(batch):
                words = W.Words(part.column(part.schema.get_field_index("text")))
                hashes = words.hashes(lower=True)
                raw = None
                docs, rows = [], {"k": [], "h": [], "shingle": [], "in_sketch": []}
                for k in lengths:
                    at, h = _runs(words, hashes, k)
                    hit = np.ones(len(h), bool)
                    for row, p in enumerate(_positions(h)):
                        p += row << FILTER_BITS
                        hit &= (bits[p >> 5] >> (p & 31).astype(np.uint32)) & 1 == 1
                    found = np.flatnonzero(hit)
                    if not len(found):
                        continue
                    raw = words.data.tobytes() if raw is None else raw
                    doc = np.searchsorted(words.bounds, at[found], side="right") - 1
                    edges = np.searchsorted(at, words.bounds)
                    for d in np.unique(doc):
                        mine = h[edges[d]:edges[d + 1]]
                        value = _bin_values(mine, len(mine))
                        ours, first = np.unique(h[found[doc == d]], return_index=True)
                        pos = found[doc == d][first]
                        docs += [d] * len(ours)
                        rows["k"] += [k] * len(ours)
                        rows["h"] += ours.view(np.int64).tolist()
                        rows["shingle"] += [_text(raw, words, int(at[p]), k) for p in pos]
                        rows["in_sketch"] += value[pos - edges[d]].tolist()
                if docs:
                    take = pa.array(docs, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [part.column(part.schema.get_field_index("doc_id")).take(take),
                         part.column(part.schema.get_field_index("text_hash")).take(take),
                         pa.array(rows["k"], pa.int32()), pa.array(rows["h"], pa.int64()),
                         pa.array(rows["shingle"], pa.string()), pa.array(rows["in_sketch"], pa.bool_())],
                        ["doc_id", "text_hash", "k", "h", "shingle", "in_sketch"])
    return run


def _text_hash(text) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def contained_items(spark: SparkSession, docs: DataFrame, items: DataFrame, text: str = "text",
                    key: str = "doc_id", item_key: str = "item_id", item_text: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, text_hash, item_id, item_hash, n_shingles, n_shared of every contained item, per text."""
    W.bounded_batches(spark)
    shingles = item_shingles(items, item_key, item_text)
    lengths = sorted(r[0] for r in shingles.select("k").distinct().collect())     # 1 to 5
    shared = spark.sparkContext.broadcast(item_filter(shingles))
    hits = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        _text_hash(text).alias("text_hash"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).mapInArrow(_hits(lengths, shared), "doc_id long, text_hash long, k int, h long, shingle string, "
                 "in_sketch boolean")
    # written: the search and the verification both read them
    hits = written(hits.distinct(), "item-hits")
    shingle = ["k", "h", "shingle"]
    item = ["item_id", "item_hash", "n_shingles"]
    long_items = F.col("n_shingles") > EXACT_SHINGLES
    searched = (hits.filter("in_sketch").join(shingles.filter(long_items), shingle)
                .groupBy("doc_id", "text_hash", *item).agg(F.count(F.lit(1)).alias("n"))
                .filter(F.col("n") >= F.col("n_shingles") * (threshold * SKETCH_SHARE)))
    exact = hits.join(shingles.filter(~long_items), shingle).select("doc_id", "text_hash", *item).distinct()
    candidates = searched.select(*exact.columns).unionByName(exact)
    # only the shingles of candidate pairs are counted
    c, h, s = candidates.alias("c"), hits.alias("h"), shingles.alias("s")
    same = lambda x, y, *names: reduce(
        and_, [F.col(f"{x}.{n}").eqNullSafe(F.col(f"{y}.{n}")) for n in names])
    shared_shingles = (c.join(h, same("c", "h", "doc_id", "text_hash"))
                       .join(s, same("c", "s", "item_id", "item_hash") & same("h", "s", *shingle)))
    return (shared_shingles.groupBy(*[F.col(f"c.{n}") for n in ("doc_id", "text_hash", *item)])
            .agg(F.count(F.lit(1)).alias("n_shared"))
            .filter(F.col("n_shared") >= F.col("n_shingles") * threshold))


def contamination(spark: SparkSession, docs: DataFrame, items: DataFrame, **names) -> DataFrame:
    """One row per document id and contained item: doc_id, item_id, n_shingles,
    n_shared, containment."""
    found = contained_items(spark, docs, items, **names)
    best = F.max(F.struct((F.col("n_shared") / F.col("n_shingles")).alias("containment"), "n_shingles", "n_shared"))
    return (found.groupBy("doc_id", "item_id").agg(best.alias("best"))
            .select("doc_id", "item_id", "best.n_shingles", "best.n_shared", "best.containment"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, items: DataFrame, text: str = "text",
                      key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose text contains no item."""
    docs, back = aside(docs, but=(text, key))
    bad = (contained_items(spark, docs, items, text, key).select(
        F.col("doc_id").alias("__d"), F.col("text_hash").alias("__h")).distinct())
    same = docs[key].cast("long").eqNullSafe(bad["__d"]) & (_text_hash(docs[text]) == bad["__h"])
    return back(docs.join(bad, same, "left_anti"))
