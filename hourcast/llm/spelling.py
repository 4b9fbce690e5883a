"""Spelling variant grouping by Bloom-guided neighbourhoods.

Two words are *near* if one inserted, deleted or replaced code point turns one into the
other.  A word's *form* is its near word that occurs most often (of as many, the first
in code point order), if that occurs at least ``RATIO`` times as often; its *root* is
where following the forms ends.

Method:

1. :func:`vocabulary` counts the words of all texts, with partial aggregation.
2. The words of one length fill a blocked Bloom filter: a word belongs to one block of
   ``LANES`` 64-bit lanes and sets one bit in each (:func:`filters`).  The bits are
   gathered in Spark as bitmaps.  Filters are broadcast in rounds of at most
   ``ROUND_BYTES``; a length that needs more is cut into shards by hash, so what is
   broadcast does not grow with the vocabulary.
3. Every word generates its deletions and replacements; an insertion is the other
   word's deletion (:func:`probe`).  They are never written out: the hash of a word is
   a sum over its code points, so numpy gets the hashes of all edits of many words from
   prefix sums, and probes the filters of the target length.
4. Only edits that a filter lets through become rows, and an exact join with the
   vocabulary removes false positives (:func:`near_pairs`).  A Bloom filter has no false
   negatives, so no pair is lost.
5. Counts and forms are aggregated from the pairs; roots by pointer doubling, in as many
   rounds as the largest count allows, since it grows ``RATIO``-fold at every step
   (:func:`group_variants`).

A word is one row, and has at most (letters x (2 x length + 1) + length) near words, so
no group grows with the input; pointers to a common root are dealt over several parts.

Defined results: null text has no words; a null id is the empty string where ids are
hashed; repeated rows count each; an empty table gives an empty table; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.llm import _words as W
from hourcast.llm._frames import hot_parts, in_every_part, with_part, written

#: Letters of a word; the spelling noise of :func:`vocabulary` needs them lower-cased.
LETTERS = "A-Za-z\\u00C0-\\u00FF"
MIN_LENGTH, MIN_COUNT, RATIO = 7, 2, 10

LANES = 4
BITS_PER_WORD = 20
ROUND_BYTES = 32 << 20
#: Bits of one gathered bitmap; a whole number of blocks.
SEGMENT_BITS = 32768
#: Edits probed at a time, and words of a probing task.
PROBES = 1 << 19
TASK_WORDS = 20_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PLACE = W.Powers(0x9E3779B97F4A7C15)


# --- vocabulary -------------------------------------------------------------------

def shorten_some(word: Column, doc_id: Column, every: int = 31) -> Column:
    """``word`` without one code point, chosen by the crc32 of ``doc_id:word``, for one
    in ``every`` (document, word)."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
    at = (h % F.char_length(word)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(word, F.lit(1), at),
                                           F.substring(word, at + 2, F.char_length(word)))).otherwise(word)


def vocabulary(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_length: int = MIN_LENGTH,
               min_count: int = MIN_COUNT, edit=shorten_some) -> DataFrame:
    """(word, n): maximal runs of letters of all texts, A-Z lower-cased and passed
    through ``edit(word, doc_id)``, with ``min_length`` code points and ``min_count``
    occurrences at least."""
    runs = F.regexp_extract_all(F.col(text), F.lit(f"[{LETTERS}]{{{min_length},}}"), 0)
    words = docs.select(F.col(doc_id).alias("id"), F.explode(runs).alias("run"))
    words = words.select("id", F.translate("run", _UPPER, _LOWER).alias("word"))
    words = words.select(edit(F.col("word"), F.col("id")).alias("word")) if edit else words
    return (words.filter(F.char_length("word") >= min_length).groupBy("word")
            .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count))


# --- hashes of words and of their edits ---------------------------------------------

def _values(cp: np.ndarray) -> np.ndarray:
    """A 64-bit value of every code point."""
    return W.mix(cp.astype(W.U64) + W.U64(0x5851F42D4C957F2D))


def _matrix(words: list[str], length: int) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.array(words, f"<U{length}").view(np.uint32).reshape(len(words), length)


def word_hashes(cp: np.ndarray) -> np.ndarray:
    """Hash of every row of code points: mixed sum of value x place."""
    up, _ = _PLACE.upto(cp.shape[1])
    return W.mix((_values(cp) * up[:cp.shape[1]]).sum(1, dtype=W.U64))


def deletion_hashes(cp: np.ndarray) -> np.ndarray:
    """Hashes of all words with one code point less, (row, place)."""
    n, length = cp.shape
    up, down = _PLACE.upto(length + 1)
    terms = _values(cp) * up[:length]
    before = np.cumsum(terms, axis=1, dtype=W.U64) - terms
    after = (terms.sum(1, dtype=W.U64)[:, None] - before - terms) * down[1]
    return W.mix(before + after)


def replacement_hashes(cp: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(flat index into (row, place, letter), hash) of all words with one code point
    replaced by a greater one, so that each unordered pair is met once."""
    length = cp.shape[1]
    up, _ = _PLACE.upto(length)
    values = _values(cp)
    total = (values * up[:length]).sum(1, dtype=W.U64)
    rest = total[:, None] - values * up[:length]
    put = _values(letters)[None, :] * up[:length][:, None]
    greater = letters[None, None, :] > cp[:, :, None]
    return np.flatnonzero(greater), W.mix((rest[:, :, None] + put[None, :, :])[greater])


# --- blocked Bloom filters ------------------------------------------------------------

def shard_plan(counts: dict[int, int], round_bytes: int = ROUND_BYTES) -> list[list[tuple[int, int, int, int]]]:
    """Rounds of filters (length, shard, shards, segments) for so many words per length;
    the filters of a round have ``round_bytes`` together at most."""
    shards = []
    for length, n in sorted(counts.items()):
        size = -(-n * BITS_PER_WORD // SEGMENT_BITS)
        most = max(1, round_bytes * 8 // SEGMENT_BITS)
        parts = -(-size // most)
        # some room, as the words of a length fall unevenly into its shards
        shards += [(length, i, parts, max(1, -(-size // parts))) for i in range(parts)]
    rounds, room = [], 0
    for shard in shards:
        if shard[3] * SEGMENT_BITS // 8 > room or not rounds:
            rounds.append([])
            room = round_bytes
        rounds[-1].append(shard)
        room -= shard[3] * SEGMENT_BITS // 8
    return rounds


def _cells(h: np.ndarray, shards: int, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shard, block, bits in the lanes) of hashes."""
    shard = (h >> W.U64(48)) % W.U64(shards)
    block = (h & W.U64((1 << 40) - 1)) % W.U64(segments * SEGMENT_BITS // (64 * LANES))
    # six bits per lane from a second mixing
    lanes = W.mix(h ^ W.U64(0xA0761D6478BD642F))
    return shard, block.astype(np.int64), lanes


def _lane_bit(lanes: np.ndarray, lane: int) -> np.ndarray:
    return (lanes >> W.U64(6 * lane)) & W.U64(63)


def _filter_bits(by_length: dict[int, list[tuple[int, int, int]]]):
    """Rows (length, shard, bit) that the words set in the filters of a round."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = np.array(batch.column(0).to_pylist(), object)
            size = batch.column(1).to_numpy()
            for length in np.unique(size):
                cp = _matrix(words[size == length].tolist(), int(length))
                _, _, parts, segments = by_length[int(length)][0]
                shard, block, lanes = _cells(word_hashes(cp), parts, segments)
                for s in by_length[int(length)]:
                    mine = shard == s[1]
                    bits = np.concatenate([
                        (block[mine] * LANES + lane) * 64 + _lane_bit(lanes[mine], lane).astype(np.int64)
                        for lane in range(LANES)])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(bits), length, np.int32)), pa.array(np.full(len(bits), s[1], np.int32)),
                         pa.array(bits // SEGMENT_BITS), pa.array(bits % SEGMENT_BITS)],
                        ["length", "shard", "segment", "bit"])
    return run


def filters(words: DataFrame, shards: list[tuple[int, int, int, int]]) -> dict[tuple[int, int], np.ndarray]:
    """The filters of one round, as arrays of 64-bit lanes; at most ``ROUND_BYTES`` in all."""
    by_length: dict[int, list] = {}
    for s in shards:
        by_length.setdefault(s[0], []).append(s)
    bits = (words.filter(F.col("length").isin(list(by_length))).select("word", "length")
            .mapInArrow(_filter_bits(by_length), "length int, shard int, segment long, bit long"))
    maps = bits.groupBy("length", "shard", "segment").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    out = {(s[0], s[1]): np.zeros(s[3] * SEGMENT_BITS // 64, np.uint64) for s in shards}
    for row in maps.collect():
        at = row["segment"] * SEGMENT_BITS // 64
        out[row["length"], row["shard"]][at:at + SEGMENT_BITS // 64] = np.frombuffer(row["bitmap"], "<u8")
    return out


def _holds(bits: np.ndarray, block: np.ndarray, lanes: np.ndarray) -> np.ndarray:
    """Indices of the hashes that the filter lets through."""
    left = np.arange(len(block))
    for lane in range(LANES):
        word = bits[block[left] * LANES + lane]
        left = left[(word >> _lane_bit(lanes[left], lane)) & W.U64(1) == 1]
    return left


# --- probing ----------------------------------------------------------------------------

def _probe(shards: list[tuple[int, int, int, int]], shared, letters: np.ndarray):
    by_length: dict[int, list] = {}
    for s in shards:
        by_length.setdefault(s[0], []).append(s)

    def hits(h: np.ndarray, length: int) -> np.ndarray:
        """Flat indices of the hashes that a filter of the round lets through."""
        mine = by_length[length]
        _, _, parts, segments = mine[0]
        shard, block, lanes = _cells(h, parts, segments)
        found = []
        for s in mine:
            here = np.arange(len(h)) if parts == 1 else np.flatnonzero(shard == s[1])
            found.append(here[_holds(shared.value[length, s[1]], block[here], lanes[here])])
        return np.concatenate(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = np.array(batch.column(0).to_pylist(), object)
            counts, size = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for length in np.unique(size).tolist():
                rows = np.flatnonzero(size == length)
                step = max(1, PROBES // (length * len(letters)))
                for a in range(0, len(rows), step):
                    mine = rows[a:a + step]
                    cp = _matrix(words[mine].tolist(), length)
                    found = []
                    if length - 1 in by_length and length > 1:
                        at = hits(deletion_hashes(cp).ravel(), length - 1)
                        row, place = np.divmod(at, length)
                        # of equal code points in a row, deleting the first stands for all
                        first = (place == 0) | (cp[row, place] != cp[row, place - 1])
                        row, place = row[first], place[first]
                        keep = np.arange(length - 1)[None, :]
                        keep = keep + (keep >= place[:, None])
                        found.append((row, np.take_along_axis(cp[row], keep, 1)))
                    if length in by_length:
                        at, h = replacement_hashes(cp, letters)
                        row, rest = np.divmod(at[hits(h, length)], length * len(letters))
                        place, letter = np.divmod(rest, len(letters))
                        edited = cp[row]
                        edited[np.arange(len(row)), place] = letters[letter]
                        found.append((row, edited))
                    for row, edited in found:
                        if not len(row):
                            continue
                        text = np.ascontiguousarray(edited.astype("<u4")).view(f"<U{edited.shape[1]}").ravel()
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(words[mine[row]].tolist(), pa.string()), pa.array(counts[mine[row]]),
                             pa.array(text.tolist(), pa.string())], ["word", "n", "near"])
    return run


def alphabet(words: DataFrame) -> np.ndarray:
    """The distinct code points of the words, ascending."""
    rows = words.select(F.explode(F.split("word", "")).alias("c")).filter("c <> ''").distinct().collect()
    return np.array(sorted(ord(r[0]) for r in rows), np.uint32)


def near_pairs(spark: SparkSession, words: DataFrame, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """(word, n, near, near_n): every unordered pair of near words of a table (word, n)
    of distinct words, once."""
    W.bounded_batches(spark)
    sized = words.select("word", "n", F.char_length("word").alias("length"))
    counts = {r[0]: r[1] for r in sized.groupBy("length").count().collect() if r[0]}
    letters = alphabet(words)
    # probing costs time by words, not by bytes, so the tasks are cut by words
    sized = sized.repartition(max(1, -(-sum(counts.values()) // TASK_WORDS)), "word")
    out = None
    for shards in shard_plan(counts, round_bytes):
        lengths = sorted({s[0] for s in shards})
        shared = spark.sparkContext.broadcast(filters(sized, shards))
        candidates = sized.filter(F.col("length").isin(sorted({*lengths, *(x + 1 for x in lengths)}))).mapInArrow(
            _probe(shards, shared, letters), "word string, n long, near string")
        out = candidates if out is None else out.unionByName(candidates)
    if out is None:
        out = spark.createDataFrame([], "word string, n long, near string")
    known = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    return out.join(known, "near").select("word", "n", "near", "near_n")


# --- forms and roots --------------------------------------------------------------------

def roots(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, root) of the words with a form, from (word, form, n)."""
    least, most = words.agg(F.min("n"), F.max("n")).first()
    hops = 0
    while least is not None and least * ratio <= most:
        least, hops = least * ratio, hops + 1
    pointer = written(words.select("word", F.col("form").alias("to")).filter(F.col("to").isNotNull()), "pointers")
    reach = 1
    while reach < hops:
        hot = hot_parts(pointer, "to")
        ahead = in_every_part(pointer.select(F.col("word").alias("to"), F.col("to").alias("next")), hot, "to", "part")
        joined = with_part(pointer, hot, "to", ["word"], "part").join(ahead, ["to", "part"], "left")
        pointer = written(joined.select("word", F.coalesce("next", "to").alias("to")), "pointers")
        reach *= 2
    return pointer.select("word", F.col("to").alias("root"))


def group_variants(spark: SparkSession, words: DataFrame, ratio: int = RATIO,
                   round_bytes: int = ROUND_BYTES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a table (word, n) of distinct words."""
    if ratio < 2:
        raise ValueError("ratio must be at least 2, or forms could follow each other for ever")
    words = written(words.select("word", "n"), "vocabulary")
    pairs = near_pairs(spark, words, round_bytes).select(F.explode(F.array(
        F.struct("word", F.col("near").alias("other"), F.col("near_n").alias("other_n")),
        F.struct(F.col("near").alias("word"), F.col("word").alias("other"), F.col("n").alias("other_n")))).alias("p"))
    best = (pairs.select("p.*").groupBy("word")
            .agg(F.count(F.lit(1)).alias("n_near"),
                 F.min(F.struct((-F.col("other_n")).alias("minus"), F.col("other"))).alias("best")))
    joined = words.join(best, "word", "left")
    fits = -F.col("best.minus") >= F.lit(ratio) * F.col("n")
    formed = written(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, F.col("best.other")).alias("form"), F.when(fits, -F.col("best.minus")).alias("form_n")), "forms")
    return (formed.join(roots(formed, ratio), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
