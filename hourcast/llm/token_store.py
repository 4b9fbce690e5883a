"""Token-id files: patched frame-of-reference blocks in ascending document order.

Layout.  A file is one Parquet part written by Spark, so a lost task leaves no
half file; its rows are segments in document order, each holding whole documents
of about ``SEGMENT_IDS`` ids.  A segment has its documents' ids and lengths, the
number of token ids before it in its file, and its token ids in blocks of
``BLOCK_IDS``.  A block stores its minimum, the bit width that holds
``PERCENTILE`` percent of its values minus that minimum, the packed low bits of
that width, and an exception list of (position, value) for the values that need
more.  ``block_starts`` indexes the byte at which every block's packed bits begin.

Documents are range-partitioned by id, so file numbers ascend with the ids, and
the ids before a document are those of earlier files (one row per file), of
earlier segments (in the segment) and of earlier documents of its segment.

Defined results: a null or empty text has the end id alone; a null ``doc_id``
sorts first; rows with equal ids are stored one after the other; an empty table
gives no segments.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourcast.llm import _words as W
from hourcast.llm.bpe import PieceCache, gather
from hourcast.session import checkpoint_dir

BLOCK_IDS = 1024
PERCENTILE = 90
SEGMENT_IDS = 1 << 18
END_ID = 2

SEGMENT = ("file_no int, segment_no long, ids_before long, n_ids long, doc_ids array<long>, doc_lengths array<int>, "
           "block_min binary, block_width binary, block_starts binary, packed binary, "
           "exception_starts binary, exception_at binary, exception_values binary")


# --- blocks -------------------------------------------------------------------------

def pack(ids: np.ndarray) -> dict[str, bytes]:
    """Blocks of one segment as the binary fields of ``SEGMENT``."""
    n = len(ids)
    blocks = -(-n // BLOCK_IDS)
    grid = np.empty(blocks * BLOCK_IDS, np.uint32)
    grid[:n] = ids
    grid[n:] = ids[-1] if n else 0
    grid = grid.reshape(blocks, BLOCK_IDS)
    low = grid.min(axis=1)
    rest = grid - low[:, None]
    rank = min(BLOCK_IDS - 1, BLOCK_IDS * PERCENTILE // 100)
    held = np.partition(rest, rank, axis=1)[:, rank].astype(np.int64)
    width = np.ceil(np.log2(held + 1)).astype(np.int64)
    over = rest >= (np.int64(1) << width)[:, None]
    block, at = np.nonzero(over)
    size = width * (BLOCK_IDS // 8)
    starts = np.concatenate([[0], np.cumsum(size)])
    packed = np.zeros(starts[-1], np.uint8)
    for w in np.unique(width):
        mine = np.flatnonzero(width == w)
        if not w:
            continue
        kind, total = (">u2", 16) if w <= 16 else (">u4", 32)
        low_bits = (rest[mine] & np.uint32((1 << int(w)) - 1)).astype(kind)
        bits = np.unpackbits(low_bits.view(np.uint8).reshape(-1, total // 8), axis=1)[:, total - w:]
        out = np.packbits(bits.reshape(len(mine), -1), axis=1)
        packed[(starts[mine][:, None] + np.arange(out.shape[1])).ravel()] = out.ravel()
    return {
        "block_min": low.astype("<u4").tobytes(), "block_width": width.astype(np.uint8).tobytes(),
        "block_starts": starts[:-1].astype("<u8").tobytes(), "packed": packed.tobytes(),
        "exception_starts": np.searchsorted(block, np.arange(blocks)).astype("<u4").tobytes(),
        "exception_at": at.astype("<u2").tobytes(),
        "exception_values": rest[over].astype("<u4").tobytes()}


def unpack(n: int, block_min: bytes, block_width: bytes, block_starts: bytes, packed: bytes,
           exception_starts: bytes, exception_at: bytes, exception_values: bytes) -> np.ndarray:
    """The ``n`` ids of a segment."""
    low = np.frombuffer(block_min, "<u4")
    width = np.frombuffer(block_width, np.uint8)
    starts = np.frombuffer(block_starts, "<u8").astype(np.int64)
    data = np.frombuffer(packed, np.uint8)
    out = np.zeros((len(low), BLOCK_IDS), np.uint32)
    for w in np.unique(width):
        if not w:
            continue
        mine = np.flatnonzero(width == w)
        raw = data[starts[mine][:, None] + np.arange(int(w) * BLOCK_IDS // 8)]
        total, kind = (16, ">u2") if w <= 16 else (32, ">u4")
        bits = np.zeros((len(mine) * BLOCK_IDS, total), np.uint8)
        bits[:, total - w:] = np.unpackbits(raw, axis=1).reshape(-1, w)
        out[mine] = np.packbits(bits, axis=1).view(kind).reshape(len(mine), BLOCK_IDS)
    first = np.frombuffer(exception_starts, "<u4").astype(np.int64)
    at = np.frombuffer(exception_at, "<u2")
    block = np.searchsorted(first, np.arange(len(at)), side="right") - 1
    out[block, at] = np.frombuffer(exception_values, "<u4")
    return (out + low[:, None]).ravel()[:n]


# --- encoding with the tokenizers library ----------------------------------------------

_GRAPH = np.zeros(256, bool)
_GRAPH[0x21:0x7F] = True
#: ASCII letters 1, digits 2, other visible characters 3; 0: not cut beside.
_KIND = np.zeros(256, np.uint8)
for _c in range(0x21, 0x7F):
    _KIND[_c] = 1 if chr(_c).isalpha() else 2 if chr(_c).isdigit() else 3
_KIND[ord("'")] = 0


def chunk_starts(data: np.ndarray, offsets: np.ndarray, whole: bytes = b"<|>") -> np.ndarray:
    """Bytes at which a text may be cut without changing its ids.

    Byte-level pieces always begin at a text's first byte, at a single space
    between two characters that are not white space, at a line feed between two
    such characters and behind it, and where ASCII letters, digits and other signs
    meet (an apostrophe apart).  Characters that could be white space or a control
    character, and those of added tokens (``whole``), are not cut beside, which
    only makes chunks longer.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    kind = _KIND.copy()
    kind[list(whole)] = 0
    pad = np.concatenate([np.zeros(3, np.uint8), data, np.full(2, 0x20, np.uint8)])
    b3, b2, b1, after = pad[:n], pad[1:n + 1], pad[2:n + 2], pad[4:n + 4]
    # not white space: the character that ends before a byte, the one that follows it
    ends = _GRAPH[b1] | ((b1 >= 0x80) & (((b2 >= 0xC3) & (b2 <= 0xDF)) | (
        (b2 >= 0x80) & (b2 < 0xC0) & (b3 >= 0xE4) & (b3 <= 0xEF))))
    begins = _GRAPH[after] | ((after >= 0xC3) & (after <= 0xDF)) | (after >= 0xE4)
    alone = ((data == 0x20) | (data == 0x0A)) & ends & begins
    last = np.zeros(n + 1, bool)
    last[offsets[1:]] = True
    first = np.zeros(n + 1, bool)
    first[offsets[:-1]] = True
    alone &= ~last[1:] & ~first[:n]
    here, before = kind[data], kind[b1]
    cut = alone | ((here != before) & (here > 0) & (before > 0))
    cut[1:] |= (alone & (data == 0x0A))[:-1]
    return np.flatnonzero(cut | first[:n])


_CACHES: dict[int, PieceCache] = {}


def _cache(shared) -> PieceCache:
    text = shared.value
    if hash(text) not in _CACHES:
        from tokenizers import Tokenizer
        library = Tokenizer.from_str(text)

        def misses(chunks: list[bytes]):
            for i in range(0, len(chunks), 4096):
                for e in library.encode_batch_fast([c.decode() for c in chunks[i:i + 4096]],
                                                   add_special_tokens=False):
                    yield e.ids
        _CACHES.clear()
        _CACHES[hash(text)] = PieceCache(misses)
    return _CACHES[hash(text)]


def _segments(shared, end_id: int, whole: bytes | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        cache = _cache(shared)
        held, n_held, before, number, file_no = [], 0, 0, 0, 0

        def flush():
            nonlocal held, n_held, before, number
            docs = pa.concat_arrays([h[0] for h in held])
            lengths = np.concatenate([h[1] for h in held])
            ids = np.concatenate([h[2] for h in held])
            row = {"file_no": file_no, "segment_no": number, "ids_before": before, "n_ids": len(ids)}
            schema = {"file_no": pa.int32(), "segment_no": pa.int64(), "ids_before": pa.int64(), "n_ids": pa.int64()}
            fields = {k: pa.array([v], schema[k]) for k, v in row.items()}
            fields["doc_ids"] = pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs)
            fields["doc_lengths"] = pa.ListArray.from_arrays(
                pa.array([0, len(lengths)], pa.int32()), pa.array(lengths.astype(np.int32)))
            fields |= {k: pa.array([v], pa.binary()) for k, v in pack(ids).items()}
            before += len(ids)
            number += 1
            held, n_held = [], 0
            return pa.RecordBatch.from_pydict(fields)

        for batch in batches:
            for part in W.slices(batch):
                file_no = part.column(2)[0].as_py()
                data, offsets = W.flat(part.column(1))
                starts = chunk_starts(data, offsets, whole) if whole is not None else np.unique(
                    offsets[:-1][offsets[:-1] < offsets[1:]])
                ids, n = cache.lookup(data.tobytes(), starts, np.append(starts[1:], len(data)))
                upto = np.concatenate([[0], np.cumsum(n)])[np.searchsorted(starts, offsets)]
                lengths = np.diff(upto)
                # one end id behind every document
                out = np.full(len(ids) + len(lengths), end_id, np.uint32)
                out[gather(upto[:-1] + np.arange(len(lengths)), lengths)] = ids
                held.append((part.column(0), lengths + 1, out))
                n_held += len(out)
                if n_held >= SEGMENT_IDS:
                    yield flush()
        if held:
            yield flush()
    return run


def write(spark: SparkSession, docs: DataFrame, folder: str, tokenizer_json: str,
          text: str = "text", key: str = "doc_id", end_id: int = END_ID) -> None:
    """Encode every whole text and write the token files to ``folder``.

    ``tokenizer_json`` is a local path, read here and sent to the tasks.  Its
    tokenizer must be byte-level BPE without normaliser; then texts are encoded by
    chunks that never share a piece, each distinct chunk once per worker.
    """
    import json
    W.bounded_batches(spark)
    with open(tokenizer_json, encoding="utf-8") as f:
        content = f.read()
    spec = json.loads(content)
    steps = spec.get("pre_tokenizer") or {}
    added = "".join(t["content"] for t in spec.get("added_tokens", []))
    cuts_words = (spec.get("normalizer") is None and steps.get("type") == "ByteLevel"
                  and not steps.get("add_prefix_space") and steps.get("use_regex", True)
                  and added.isascii() and not set(added) & set(" \n"))
    whole = added.encode() if cuts_words else None
    shared = spark.sparkContext.broadcast(content)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
     # rows that share an id, or have none, are dealt by their texts
     .repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
     .sortWithinPartitions(F.col("doc_id").asc_nulls_first())
     .withColumn("file_no", F.spark_partition_id())
     .mapInArrow(_segments(shared, end_id, whole), SEGMENT)
     .write.parquet(folder))


def _read(with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                get = {n: row.column(j)[0] for j, n in enumerate(batch.schema.names)}
                ids = unpack(get["n_ids"].as_py(), *(get[k].as_py() for k in (
                    "block_min", "block_width", "block_starts", "packed",
                    "exception_starts", "exception_at", "exception_values")))
                lengths = get["doc_lengths"].values.to_numpy(zero_copy_only=False).astype(np.int64)
                upto = np.concatenate([[0], np.cumsum(lengths)])
                raw = ids.astype("<u4")
                crc = [zlib.crc32(raw[a:b]) for a, b in zip(upto[:-1], upto[1:])]
                columns = {
                    "file_no": pa.array(np.full(len(lengths), get["file_no"].as_py(), np.int32)),
                    "doc_id": get["doc_ids"].values,
                    "in_file": pa.array(upto[:-1] + get["ids_before"].as_py()),
                    "n_tokens": pa.array(lengths), "ids_crc32": pa.array(np.array(crc, np.int64))}
                if with_ids:
                    columns["ids"] = pa.ListArray.from_arrays(
                        pa.array(upto.astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_pydict(columns)
    return run


def read(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """Documents of the token files: doc_id, start, n_tokens, ids_crc32 (and ``ids``)."""
    segments = spark.read.parquet(folder)
    # one row per file: its ids and those of the files before it
    files = segments.groupBy("file_no").agg(F.sum("n_ids").alias("file_ids"))
    files = files.select("file_no", (F.sum("file_ids").over(
        Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        - F.col("file_ids")).alias("files_before"))
    out = segments.mapInArrow(_read(with_ids), "file_no int, doc_id long, in_file long, n_tokens long, "
                              "ids_crc32 long" + ", ids array<int>" * with_ids)
    return out.join(files, "file_no").select(
        "doc_id", (F.col("in_file") + F.col("files_before")).alias("start"), "n_tokens", "ids_crc32",
        *["ids"] * with_ids)


def store_folder(spark: SparkSession) -> str:
    """A new folder for token files under the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/token-store-{uuid.uuid4().hex}"
