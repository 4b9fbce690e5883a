"""SimHash near-dedup: fingerprints linked by a binary trie self-join.

A fingerprint bit is the majority of that bit over the XXH64 hashes (seed 42) of
all word shingles, repeats included.  Fingerprints differing in at most
``MAX_BITS`` bits are linked; a document's component is the smallest ``doc_id``
reachable over links.

Links are found with a binary trie over the distinct fingerprints: node pairs are
walked down together, a pair's differing bits are added up, and the pair is
dropped once they exceed the error budget.  To deal the trie out to tasks, the 64
bits are cut into ``MAX_BITS + 2`` blocks: two linked fingerprints agree in two
blocks at least, so for every choice of two blocks the bits are reordered with
these first, and the walk starts at the nodes below that equal prefix.  A node
pair whose fingerprints are known to be in one component already is not walked,
and tasks emit a spanning forest of their links, so a group of thousands of near
copies never becomes all its pairs.  Components are then closed by a distributed
minimum propagation over written tables.

Defined results: a null or empty text has fingerprint zero and links like any
other; equal rows share a fingerprint and so a component; a null ``doc_id`` takes
part in links and counts as larger than every id (a component of null ids only
has a null id); an empty table gives an empty table.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.llm import _words as W
from hourcast.llm._frames import aside
from hourcast.session import checkpoint_dir

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Node pairs of at most this many fingerprint pairs are compared one by one.
LEAF_PAIRS = 64
#: Node pairs walked at a time.
FRONTIER = 1 << 18
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
LOWER = bytes.maketrans(_UPPER, _UPPER.lower())


def fingerprint(text: str | None, k: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of one text."""
    # bytes.split() splits at exactly the six ASCII white-space bytes
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    votes, n = np.zeros(64, np.int64), max(1, len(words) - k + 1)
    digest = xxhash.xxh64_intdigest
    for i in range(0, n, 1 << 16):
        part = words[i:min(n, i + (1 << 16)) + k - 1]
        if len(part) >= k:
            runs = zip(*(part[j:len(part) - k + 1 + j] for j in range(k)))
        else:
            runs = [part]
        h = np.array([digest(b" ".join(r), SEED) for r in runs], np.uint64)
        votes += _bit_counts(h)
    bits = (votes * 2 > n).astype(np.uint64)
    return int(np.sum(bits << np.arange(64, dtype=np.uint64), dtype=np.uint64))


def _bit_counts(h: np.ndarray) -> np.ndarray:
    return np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)


def _fingerprints(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t, k) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(fp.view(np.int64))],
                                             ["doc_id", "row_hash", "fp"])
    return run


# --- trie self-join -------------------------------------------------------------

def block_orders(max_bits: int = MAX_BITS) -> list[tuple[np.ndarray, int]]:
    """For every choice of two of the ``max_bits + 2`` blocks: the order of the 64
    bits (first those of the chosen blocks) and the length of the equal prefix."""
    edges = np.linspace(0, 64, max_bits + 3).round().astype(int)
    blocks = [list(range(a, b)) for a, b in zip(edges, edges[1:])]
    out = []
    for pick in itertools.combinations(range(len(blocks)), 2):
        head = [b for i in pick for b in blocks[i]]
        tail = [b for i in range(len(blocks)) if i not in pick for b in blocks[i]]
        out.append((np.array(head + tail), len(head)))
    return out


def _reorder(fp: np.ndarray, order: np.ndarray) -> np.ndarray:
    out = np.zeros(len(fp), np.uint64)
    for to, bit in enumerate(order):
        out |= ((fp >> np.uint64(63 - bit)) & np.uint64(1)) << np.uint64(63 - to)
    return out


def _root(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    while True:
        up = parent[x]
        if (up == x).all():
            return x
        parent[x] = parent[up]
        x = parent[x]


def _union(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the components of all pairs (a, b), vectorised."""
    while len(a):
        a, b = _root(parent, a), _root(parent, b)
        apart = a != b
        a, b = a[apart], b[apart]
        if not len(a):
            return
        low, high = np.minimum(a, b), np.maximum(a, b)
        np.minimum.at(parent, high, low)


def _link_flips(keys: np.ndarray, parent: np.ndarray) -> None:
    """Join keys that differ in one bit (a cheap first pass over dense groups)."""
    for bit in range(64):
        other = keys ^ np.uint64(1 << bit)
        at = np.searchsorted(keys, other)
        at[at == len(keys)] = 0
        hit = np.flatnonzero(keys[at] == other)
        if len(hit):
            _union(parent, hit, at[hit])


def trie_links(keys: np.ndarray, depth: int, max_bits: int = MAX_BITS) -> np.ndarray:
    """Component root (index) of every sorted distinct key, over links between keys
    that agree in the first ``depth`` bits and differ in at most ``max_bits``."""
    n = len(keys)
    parent = np.arange(n)
    if n < 2:
        return parent
    prefix = keys >> np.uint64(64 - depth)
    cut = np.concatenate([[0], np.flatnonzero(prefix[1:] != prefix[:-1]) + 1, [n]])
    lo, hi = cut[:-1], cut[1:]
    many = hi - lo > 1
    if not many.any():
        return parent
    if (hi - lo).max() > LEAF_PAIRS:
        _link_flips(keys, parent)
    # frontier entry: node [a, b) with node [c, d), bits seen, errors so far
    lo, hi = lo[many], hi[many]
    stack = [(depth, lo, hi, lo, hi, np.zeros(len(lo), np.int64))]
    while stack:
        level, a, b, c, d, err = stack.pop()
        if len(a) > FRONTIER:
            for i in range(0, len(a), FRONTIER):
                s = slice(i, i + FRONTIER)
                stack.append((level, a[s], b[s], c[s], d[s], err[s]))
            continue
        if not len(a):
            continue
        live = ~_one_component(parent, a, b, c, d)
        a, b, c, d, err = (x[live] for x in (a, b, c, d, err))
        small = ((b - a) * (d - c) <= LEAF_PAIRS) | (level >= 64)
        _leaf(keys, parent, a[small], b[small], c[small], d[small], max_bits)
        a, b, c, d, err = (x[~small] for x in (a, b, c, d, err))
        if not len(a):
            continue
        m1, m2 = _split(keys, a, b, level), _split(keys, c, d, level)
        same = a == c
        kids = [(a, m1, c, m2, err), (m1, b, m2, d, err), (a, m1, m2, d, err + 1),
                (m1[~same], b[~same], c[~same], m2[~same], err[~same] + 1)]
        na, nb, nc, nd, ne = (np.concatenate(x) for x in zip(*kids))
        ok = (na < nb) & (nc < nd) & (ne <= max_bits) & ~((na == nc) & (nb - na < 2))
        stack.append((level + 1, na[ok], nb[ok], nc[ok], nd[ok], ne[ok]))
    return _root(parent, np.arange(n))


def _split(keys, lo, hi, level):
    """First index in [lo, hi) whose bit ``level`` is set (keys agree above it)."""
    bit = np.uint64(1 << (63 - level))
    target = (keys[lo] & ~(bit - np.uint64(1))) | bit
    return np.clip(np.searchsorted(keys, target), lo, hi)


def _one_component(parent, a, b, c, d):
    """Node pairs whose fingerprints all have one root already."""
    roots = _root(parent, np.arange(len(parent)))
    change = np.concatenate([[0], np.cumsum(roots[1:] != roots[:-1])])
    return (change[b - 1] == change[a]) & (change[d - 1] == change[c]) & (roots[a] == roots[c])


def _leaf(keys, parent, a, b, c, d, max_bits):
    if not len(a):
        return
    size = (b - a) * (d - c)
    for part in np.array_split(np.arange(len(a)), max(1, int(size.sum() >> 22))):
        if not len(part):
            continue
        n = size[part]
        first = np.concatenate([[0], np.cumsum(n)[:-1]])
        at = np.arange(n.sum()) - np.repeat(first, n)
        wide = np.repeat((d - c)[part], n)
        x = np.repeat(a[part], n) + at // wide
        y = np.repeat(c[part], n) + at % wide
        near = (x != y) & (np.bitwise_count(keys[x] ^ keys[y]) <= max_bits)
        _union(parent, x[near], y[near])


def _trie_join(max_bits: int):
    orders = block_orders(max_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_order, kept = -1, []

        def solve(order, keys):
            roots = trie_links(keys, orders[order][1], max_bits)
            child = np.flatnonzero(roots != np.arange(len(keys)))
            if len(child):
                back = np.argsort(orders[order][0])
                a, b = (_reorder(keys[i], back).view(np.int64) for i in (child, roots[child]))
                return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
            return None

        def cut(order, keys, last):
            """Solve whole prefixes; what may go on in the next batch is kept."""
            nonlocal kept
            if not last:
                shift = np.uint64(64 - orders[order][1])
                stop = int(np.searchsorted(keys >> shift, keys[-1] >> shift))
                kept = [keys[stop:]]
                keys = keys[:stop]
            else:
                kept = []
            return solve(order, keys) if len(keys) > 1 else None

        for batch in batches:
            order = batch.column(0).to_numpy()
            keys = (batch.column(1).to_numpy().view(np.uint64) ^ np.uint64(1 << 63))
            edges = np.concatenate([[0], np.flatnonzero(np.diff(order)) + 1, [len(order)]])
            for lo, hi in zip(edges, edges[1:]):
                if hi == lo:
                    continue
                if order[lo] != kept_order:
                    if kept and (out := cut(kept_order, np.concatenate(kept), True)) is not None:
                        yield out
                    kept_order, kept = int(order[lo]), []
                kept.append(keys[lo:hi])
                if sum(map(len, kept)) > 200_000:
                    if (out := cut(kept_order, np.concatenate(kept), False)) is not None:
                        yield out
        if kept and (out := cut(kept_order, np.concatenate(kept), True)) is not None:
            yield out
    return run


def _orderings(max_bits: int):
    orders = block_orders(max_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            for i, (order, depth) in enumerate(orders):
                keys = _reorder(fp, order)
                # signed storage whose sort order is that of the unsigned key
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), i, np.int32)),
                     pa.array((keys ^ np.uint64(1 << 63)).view(np.int64)),
                     pa.array((keys >> np.uint64(64 - depth)).astype(np.int64))],
                    ["ordering", "key", "prefix"])
    return run


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Spanning links (a, b) between distinct fingerprints ``fp``."""
    dealt = fps.select("fp").mapInArrow(_orderings(max_bits), "ordering int, key long, prefix long")
    return (dealt.repartition("ordering", "prefix").sortWithinPartitions("ordering", "key")
            .select("ordering", "key").mapInArrow(_trie_join(max_bits), "a long, b long"))


def components(spark: SparkSession, edges: DataFrame, folder: str) -> DataFrame:
    """(node, root) of all nodes of ``edges`` (a, b); root is the smallest node.

    Alternates two star steps until nothing moves: every node's neighbours are
    pointed at the smallest of them.  The step's table is written to ``folder``
    each round, so lineage stays short and lost executors cost one round only.
    """
    def step(e: DataFrame, larger_only: bool) -> DataFrame:
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select("u", F.least("m", "u").alias("m"))
        out = e.join(low, "u")
        if larger_only:
            out = out.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = out.select(F.explode(F.array(
                F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("s")).select(
                F.col("s.v").alias("u"), F.col("s.m").alias("v"))
        return out.filter(F.col("u") != F.col("v")).distinct()

    def save(df: DataFrame, i: int) -> DataFrame:
        df.write.parquet(f"{folder}/{i}")
        return spark.read.parquet(f"{folder}/{i}")

    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    now, before, i = save(both.filter("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), 0), None, 0
    while True:
        i += 1
        two_way = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = step(two_way, True).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        now = save(step(large, False).filter("u > v"), i)
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _row_hash(text: str, key: str) -> Column:
    """Hash of a text, another one where the row has no id."""
    return F.xxhash64(F.col(key).isNull(), F.coalesce(F.col(text).cast("string"), F.lit("")))


def _grouped(spark: SparkSession, docs: DataFrame, first: Column, text: str, key: str,
             shingle_words: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, row_hash, fp), and per distinct ``fp`` the smallest ``first`` of
    all rows in its component."""
    W.bounded_batches(spark)
    folder = f"{checkpoint_dir(spark).rstrip('/')}/simhash-{uuid.uuid4().hex}"
    (docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
                 _row_hash(text, key).alias("row_hash"))
     .mapInArrow(_fingerprints(shingle_words), "doc_id long, row_hash long, fp long")
     .write.parquet(f"{folder}/fingerprints"))
    rows = spark.read.parquet(f"{folder}/fingerprints")
    rows.groupBy("fp").agg(F.min(first).alias("first")).write.parquet(f"{folder}/distinct")
    distinct = spark.read.parquet(f"{folder}/distinct")
    roots = components(spark, links(distinct, max_bits), f"{folder}/components")
    linked = distinct.join(roots, distinct.fp == roots.node).select("fp", "root", "first")
    smallest = linked.groupBy("root").agg(F.min("first").alias("least"))
    linked = linked.join(smallest, "root").select("fp", "least")
    return rows, distinct.join(linked, "fp", "left").select("fp", F.coalesce("least", "first").alias("first"))


def near_duplicates(spark: SparkSession, docs: DataFrame, text: str = "text", key: str = "doc_id",
                    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id."""
    rows, by_fp = _grouped(spark, docs, F.col("doc_id"), text, key, shingle_words, max_bits)
    return rows.join(by_fp, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("first").alias("component_id"))


def keep_one(spark: SparkSession, docs: DataFrame, text: str = "text", key: str = "doc_id",
             shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of every component of ``docs``, with all columns.

    It is that of the smallest id (rows without an id come last), of rows with that id
    the one whose text has the smallest hash, and one of rows with equal id and text.
    Equal rows are reduced per task before the texts are shuffled, once.
    """
    docs, back = aside(docs, but=(text, key))
    id_ = F.coalesce(F.col(key).cast("long"), F.lit(0))
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("__id"),
                     F.col("row_hash").alias("__hash"))
    _, by_fp = _grouped(spark, docs, first, text, key, shingle_words, max_bits)
    stay = by_fp.select("first.__id", "first.__hash").distinct()
    return (docs.withColumns({"__id": id_, "__hash": _row_hash(text, key)}).dropDuplicates(["__id", "__hash"])
            .join(stay, ["__id", "__hash"], "left_semi").select(*docs.columns).transform(back))
