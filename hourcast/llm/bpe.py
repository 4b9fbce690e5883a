"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Method: texts become arrays of codepoint classes; piece boundaries come from class
changes and from a four-state machine whose transition functions are combined by
an associative scan, without a regular expression.  The pieces are byte slices;
each distinct piece is merged once per worker by pair ranks and then looked up.  The
byte offset of every token is kept beside its id, counted from the start of its piece;
decoding puts the bytes of a token at its offset and raises unless the tokens of a text
follow each other without a gap.

The pieces are those of the public pattern ``PATTERN`` of the vocabulary file:
a contraction (``'s 't 're 've 'm 'll 'd``), a run of letters, of numbers or of
other characters with at most one space before it, or white space (all of it but
the last character if something follows).

:func:`roundtrip` encodes and decodes a text in one pass, so that a task keeps one
Python worker with one vocabulary.  A worker holds the ranks (about 10 MB for 50,000
tokens), a cache of at most ``CACHE_PIECES`` pieces and the arrays of a slice of 1 MB.

Defined results: a null or empty text has no ids and decodes to empty bytes;
decoding the ids gives the text's UTF-8 bytes back; an empty table gives an empty
table; rows are independent, so repeated rows give equal results.  Input columns are
kept; the added columns replace input columns of the same name, whatever its case.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.llm import _words as W
from hourcast.llm._frames import fresh, quoted, without

LETTER, NUMBER, BLANK, OTHER = 1, 2, 3, 0
#: The code points of Unicode's White_Space property.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
               0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Letters that make a contraction after an apostrophe.
SHORT, LONG = "stmd", ("re", "ve", "ll")

#: Distinct pieces kept per worker, about 60 bytes each; beyond it the cache starts anew.
CACHE_PIECES = 900_000
#: Pieces longer than this many bytes are merged anew each time.
CACHE_BYTES = 64

_CLASSES: np.ndarray | None = None


def classes() -> np.ndarray:
    """Class of every code point, built from the general categories once per worker."""
    global _CLASSES
    if _CLASSES is None:
        kind = {"L": LETTER, "N": NUMBER}
        out = np.fromiter((kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)),
                          np.uint8, 0x110000)
        out[WHITE_SPACE] = BLANK
        _CLASSES = out
    return _CLASSES


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points, byte offset of each) of valid UTF-8 bytes."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    cp = data[at].astype(np.uint32)
    wide = np.flatnonzero(cp >= 0x80)
    if len(wide):
        lead, where = cp[wide], at[wide]
        pad = np.concatenate([data, np.zeros(3, np.uint8)])
        b1, b2, b3 = (pad[where + i].astype(np.uint32) & 0x3F for i in (1, 2, 3))
        cp[wide] = np.where(lead < 0xE0, (lead & 0x1F) << 6 | b1, np.where(
            lead < 0xF0, (lead & 0x0F) << 12 | b1 << 6 | b2,
            (lead & 0x07) << 18 | b1 << 12 | b2 << 6 | b3))
    return cp, at


# --- transition functions --------------------------------------------------------
# States before a character: 0 plain; 1 or 2: so many letters still belong to the
# contraction that is open; 3: a contraction has just ended.  A function of these
# four states is one byte, two bits per state.

def _function(images) -> int:
    return sum(image << (2 * state) for state, image in enumerate(images))


_RESET = _function((0, 0, 0, 0))
_LETTER = _function((0, 3, 1, 0))
_OPEN_1 = _function((1, 1, 1, 1))
_OPEN_2 = _function((2, 2, 2, 2))
_IDENTITY = _function((0, 1, 2, 3))


def _composition() -> np.ndarray:
    """Table of "first f, then g" over all 256 x 256 pairs of functions."""
    f, g = np.arange(256)[:, None], np.arange(256)[None, :]
    out = np.zeros((256, 256), np.int64)
    for state in range(4):
        out |= ((g >> (2 * ((f >> (2 * state)) & 3))) & 3) << (2 * state)
    return out.astype(np.uint8).ravel()


_THEN = _composition()
_SPAN = 256


def states_before(functions: np.ndarray) -> np.ndarray:
    """State before every character, by an associative scan of transition functions:
    prefixes within spans of characters, then over the spans' totals."""
    n = len(functions)
    rows = -(-n // _SPAN)
    grid = np.full(rows * _SPAN, _IDENTITY, np.uint8)
    grid[:n] = functions
    grid = np.ascontiguousarray(grid.reshape(rows, _SPAN).T)
    prefix = np.empty((_SPAN + 1, rows), np.uint8)
    prefix[0] = _IDENTITY
    for j in range(_SPAN):
        prefix[j + 1] = _THEN[prefix[j].astype(np.uint16) << 8 | grid[j]]
    total, step = prefix[_SPAN].copy(), 1
    while step < rows:
        total[step:] = _THEN[total[:-step].astype(np.uint16) << 8 | total[step:]]
        step *= 2
    carry = np.concatenate([[0], total[:-1] & 3]).astype(np.uint8)   # state 0 at the start
    state = (prefix[:_SPAN] >> (2 * carry)[None, :]) & 3
    return np.ascontiguousarray(state.T).ravel()[:n]


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte offsets at which a piece begins, over all texts of a flat column."""
    if not len(data):
        return np.zeros(0, np.int64)
    cp, at = code_points(data)
    n = len(cp)
    kind = classes()[cp]
    fresh = np.zeros(n + 1, bool)                       # first character of a text
    fresh[np.searchsorted(at, offsets[:-1])] = True
    fresh[n] = True
    first, last = fresh[:n], fresh[1:]
    before = np.concatenate([[OTHER], kind[:-1]])
    blank = kind == BLANK
    space = cp == 0x20
    # a space goes with what follows it; a space before white space does not
    joins = space & ~last & ~np.concatenate([blank[1:], [True]])
    joined = np.concatenate([[False], joins[:-1]]) & ~first
    # contractions: an apostrophe that begins a piece, then one or two given letters
    open_1 = open_2 = np.zeros(0, np.int64)
    tick = np.flatnonzero((cp == 0x27) & ~joined & ~last)
    if len(tick):
        # an apostrophe behind another character of its class continues that piece
        tick = tick[first[tick] | (before[tick] != OTHER)]
        one = cp[tick + 1]
        open_1 = tick[np.isin(one, [ord(c) for c in SHORT])]
        more = tick[(tick + 2 < n) & ~last[np.minimum(tick + 1, n - 1)]]
        two = cp[more + 1].astype(np.int64) << 32 | cp[np.minimum(more + 2, n - 1)]
        open_2 = more[np.isin(two, [ord(a) << 32 | ord(b) for a, b in LONG])]
    functions = np.where(kind == LETTER, _LETTER, _RESET).astype(np.uint8)
    functions[first] = _RESET
    functions[open_1] = _OPEN_1
    functions[open_2] = _OPEN_2
    state = states_before(functions)
    state[first] = 0
    change = (kind != before) | first
    starts = change & (state != 1) & (state != 2)
    starts |= (state == 3)
    starts &= ~joined
    # white space: the last character before something else stands apart
    inner = blank & ~last & ~np.concatenate([blank[1:], [True]])
    starts |= inner
    return at[starts]


# --- pair merging -----------------------------------------------------------------

def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: per line a base64 token and its id."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: join the adjacent pair of lowest rank until none is left."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) > CACHE_BYTES:
        return _merge_long(piece, ranks)
    parts = [piece[i:i + 1] for i in range(len(piece))]
    pairs = [ranks.get(a + b) for a, b in zip(parts, parts[1:])]
    while True:
        best = min((r for r in pairs if r is not None), default=None)
        if best is None:
            return [ranks[p] for p in parts]
        i = pairs.index(best)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i])
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1])


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap of pairs over a linked list, n log n in the length."""
    n = len(piece)
    end, after, prior = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []

    def push(i):
        j = after[i]
        if j < n:
            r = ranks.get(piece[i:end[j]])
            if r is not None:
                heapq.heappush(heap, (r, i, end[i], end[j]))

    for i in range(n - 1):
        push(i)
    live = [True] * n
    while heap:
        _, i, mid, stop = heapq.heappop(heap)
        if not live[i] or end[i] != mid or after[i] >= n or end[after[i]] != stop:
            continue
        j = after[i]
        live[j] = False
        end[i], after[i] = stop, after[j]
        if after[i] < n:
            prior[after[i]] = i
        push(i)
        if prior[i] >= 0:
            push(prior[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = after[i]
    return out


class PieceCache:
    """Ids of distinct pieces, bounded; looks up whole arrays of slices.

    An open-addressing hash table in numpy arrays maps a piece's 64-bit hash to its
    slot; a lookup probes all pieces of a slice of texts at once.
    """

    def __init__(self, encode_misses):
        self.encode_misses = encode_misses
        self._clear()

    def _clear(self):
        self.ids = np.zeros(1 << 16, np.int32)
        self.begin = np.zeros(1 << 16, np.int64)
        self.n_slots = self.n_ids = 0
        self._table(1 << 17)

    def _table(self, size: int) -> None:
        self.keys, self.slots = np.zeros(size, np.uint64), np.zeros(size, np.int32)

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Slot of every hash, or -1."""
        mask = W.U64(len(self.keys) - 1)
        at = h & mask
        out = np.full(len(h), -1, np.int64)
        todo = np.arange(len(h))
        while len(todo):
            key = self.keys[at[todo]]
            hit = key == h[todo]
            out[todo[hit]] = self.slots[at[todo[hit]]]
            todo = todo[~hit & (key != 0)]
            at[todo] = (at[todo] + W.U64(1)) & mask
        return out

    def _insert(self, h: np.ndarray, slots: np.ndarray) -> None:
        """Enter distinct hashes that are not in the table yet."""
        if 2 * (self.n_slots + len(h)) > len(self.keys):
            used = self.keys != 0
            old, old_slots, size = self.keys[used], self.slots[used], len(self.keys)
            while 2 * (self.n_slots + len(h)) > size:
                size *= 2
            self._table(size)
            self._insert_all(old, old_slots)
        self._insert_all(h, slots)

    def _insert_all(self, h: np.ndarray, slots: np.ndarray) -> None:
        mask = W.U64(len(self.keys) - 1)
        at = h & mask
        while len(h):
            free = self.keys[at] == 0
            self.keys[at[free]] = h[free]                    # of several for one cell the last stays
            placed = self.keys[at] == h
            self.slots[at[placed]] = slots[placed]
            h, slots, at = h[~placed], slots[~placed], (at[~placed] + W.U64(1)) & mask

    def _add(self, pieces: list[bytes]) -> np.ndarray:
        """Slots of new pieces."""
        found = list(self.encode_misses(pieces)) if pieces else []
        n = np.fromiter(map(len, found), np.int64, len(found))
        total = int(n.sum())
        while self.n_ids + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.n_slots + len(found) + 1 > len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
        self.ids[self.n_ids:self.n_ids + total] = np.fromiter(
            itertools.chain.from_iterable(found), np.int64, total)
        self.begin[self.n_slots + 1:self.n_slots + len(found) + 1] = self.n_ids + np.cumsum(n)
        slots = np.arange(self.n_slots, self.n_slots + len(found))
        self.n_slots += len(found)
        self.n_ids += total
        return slots

    def lookup(self, raw: bytes, starts: np.ndarray, ends: np.ndarray):
        """(ids of all slices one after the other, number of ids of each slice)."""
        if self.n_slots > CACHE_PIECES:
            self._clear()
        h = W.span_hashes(np.frombuffer(raw, np.uint8), starts, ends)
        h[h == 0] = 1                                        # 0 marks a free cell
        slot = self._find(h)
        missing = np.flatnonzero(slot < 0)
        kept = self.n_slots, self.n_ids
        if len(missing):
            new, first, which = np.unique(h[missing], return_index=True, return_inverse=True)
            first = missing[first]
            short = ends[first] - starts[first] <= CACHE_BYTES
            mine = np.empty(len(new), np.int64)
            for kind in (short, ~short):
                mine[kind] = self._add([raw[a:b] for a, b in zip(starts[first[kind]].tolist(),
                                                                 ends[first[kind]].tolist())])
                if kind is short:
                    kept = self.n_slots, self.n_ids
            self._insert(new[short], mine[short])
            slot[missing] = mine[which]
        n = self.begin[slot + 1] - self.begin[slot]
        ids = self.ids[gather(self.begin[slot], n)]
        self.n_slots, self.n_ids = kept                      # long pieces are not kept
        return ids, n


def gather(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Indices ``begin[i] .. begin[i] + n[i] - 1`` for all i, one after the other."""
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(begin - (ends - n), n)


class Vocabulary:
    """A vocabulary as a worker needs it: ranks, the bytes of all ids, and piece cache."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, i in ranks.items():
            tokens[i] = token
        self.raw = np.frombuffer(b"".join(tokens), np.uint8)
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.begin = np.cumsum(self.length) - self.length
        self.cache = PieceCache(lambda pieces: (merge(p, ranks) for p in pieces))

    def encode(self, data: np.ndarray, offsets: np.ndarray):
        """(ids, byte offset of each in its text, bounds of the texts' ids) of flat texts."""
        starts = piece_starts(data, offsets)
        ids, n = self.cache.lookup(data.tobytes(), starts, np.append(starts[1:], len(data)))
        upto = np.concatenate([[0], np.cumsum(n)])
        bounds = upto[np.searchsorted(starts, offsets)]
        before = np.cumsum(self.length[ids]) - self.length[ids]
        first = np.append(before, 0)[upto[:-1]]              # of the piece's first token
        at = np.repeat(starts - first, n) + before
        return ids, (at - np.repeat(offsets[:-1], np.diff(bounds))).astype(np.int32), bounds

    def decode(self, ids: np.ndarray, at: np.ndarray | None, bounds: np.ndarray):
        """(bytes, offsets) of the texts; ``at``, if given, must place the tokens gaplessly."""
        size = self.length[ids]
        upto = np.concatenate([[0], np.cumsum(size)])
        offsets = upto[bounds]
        where = upto[:-1]
        if at is not None:
            where = at + np.repeat(offsets[:-1], np.diff(bounds))
            if not np.array_equal(where, upto[:-1]):
                raise ValueError("token offsets leave gaps or overlap")
        out = np.empty(upto[-1], np.uint8)
        out[gather(where, size)] = self.raw[gather(self.begin[ids], size)]
        return out, offsets


_LOADED: dict[str, Vocabulary] = {}


def _vocabulary(shared) -> Vocabulary:
    """The worker's vocabulary, kept over its tasks; known by the digest of its file."""
    digest, ranks = shared.value
    if digest not in _LOADED:
        _LOADED.clear()
        _LOADED[digest] = Vocabulary(ranks)
    return _LOADED[digest]


def _shared(spark: SparkSession, path: str):
    with open(path, "rb") as f:
        digest = hashlib.sha256(f.read()).hexdigest()
    return spark.sparkContext.broadcast((digest, read_ranks(path)))


def _lists(bounds: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values, pa.int32()))


def _binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(
        pa.large_binary(), len(offsets) - 1,
        [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())


def _encode(names: list[str], text: str, shared, decoded: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(shared)
        for batch in batches:
            for part in W.slices(batch, text):
                ids, at, bounds = vocabulary.encode(*W.flat(part.column(part.schema.get_field_index(text))))
                added = [_lists(bounds, ids), _lists(bounds, at)]
                if decoded:
                    added.append(_binary(*vocabulary.decode(ids, at, bounds)))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(part.schema.get_field_index(x)) for x in names), *added],
                    [*names, *_added(decoded)])
    return run


def _added(decoded: bool) -> list[str]:
    return ["ids", "offsets", *(["decoded"] if decoded else [])]


def _schema(df: DataFrame) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema.fields)


def _encoded(spark: SparkSession, docs: DataFrame, ranks_path: str, text: str, decoded: bool) -> DataFrame:
    W.bounded_batches(spark)
    base = without(docs, *_added(decoded))
    (source,) = fresh(docs, "source_text")
    return (docs.select(*[quoted(c) for c in base.columns], F.coalesce(docs[text], F.lit("")).alias(source))
            .mapInArrow(_encode(base.columns, source, _shared(spark, ranks_path), decoded),
                        _schema(base) + "ids array<int>, offsets array<int>" + (", decoded binary" if decoded else "")))


def encode(spark: SparkSession, docs: DataFrame, ranks_path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids``, the token ids of every whole text, and ``offsets``, the byte
    offset of each token in its text.

    The vocabulary file is read where this is called and sent to the tasks.
    """
    return _encoded(spark, docs, ranks_path, text, False)


def roundtrip(spark: SparkSession, docs: DataFrame, ranks_path: str, text: str = "text") -> DataFrame:
    """:func:`encode`, and ``decoded``, the bytes that ids and offsets give back, in one pass."""
    return _encoded(spark, docs, ranks_path, text, True)


def _decode(names: list[str], shared, placed: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(shared)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("ids"))
            lists = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            ids = column.flatten().to_numpy(zero_copy_only=False)
            at = batch.column(batch.schema.get_field_index("offsets")).flatten().to_numpy(zero_copy_only=False) \
                if placed else None
            bounds = np.concatenate([[0], np.cumsum(lists)])
            begin_doc, step = 0, 1 << 18
            while begin_doc < len(lists):
                stop = int(np.searchsorted(bounds, bounds[begin_doc] + step, side="right")) - 1
                stop = min(len(lists), max(stop, begin_doc + 1))
                mine = slice(bounds[begin_doc], bounds[stop])
                blob = _binary(*vocabulary.decode(ids[mine], at[mine] if placed else None,
                                                  bounds[begin_doc:stop + 1] - bounds[begin_doc]))
                part = batch.slice(begin_doc, stop - begin_doc)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(part.schema.get_field_index(x)) for x in names), blob],
                    [*names, "decoded"])
                begin_doc = stop
    return run


def decode(spark: SparkSession, encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` with its columns and ``decoded``, the bytes that ``ids`` stand for; where
    it has ``offsets`` too, every token goes to its offset."""
    W.bounded_batches(spark)
    base = without(encoded, "decoded")
    return base.mapInArrow(_decode(base.columns, _shared(spark, ranks_path), "offsets" in base.columns),
                           _schema(base) + "decoded binary")
