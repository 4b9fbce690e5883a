import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from conftest import SF
from hourcast.llm import token_store as T
from hourcast.llm.queries import op7_token_store
from test_bpe import hard_texts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_blocks_give_their_ids_back():
    rng = np.random.default_rng(1)
    skewed = rng.integers(0, 50, 5000).astype(np.uint32)
    skewed[rng.integers(0, 5000, 40)] = 2 ** 31
    for ids in (skewed, np.zeros(1, np.uint32), np.full(1024, 9, np.uint32), np.arange(1025, dtype=np.uint32),
                rng.integers(0, 2 ** 32, 3000, dtype=np.uint32), rng.integers(0, 50_257, 10_000).astype(np.uint32)):
        fields = T.pack(ids)
        assert (T.unpack(len(ids), **fields) == ids).all()
    packed = T.pack(skewed)
    assert max(packed["block_width"]) == 6 and len(packed["exception_at"]) >= 70


def expected(library, docs):
    out, start = [], 0
    for d, text in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def stored(spark, df):
    folder = T.store_folder(spark)
    T.write(spark, df, folder, PATH)
    return T.read(spark, folder), folder


def test_hard_texts_nulls_and_order(spark, library, monkeypatch):
    docs = [(i * 7 % 2003, t) for i, t in enumerate(hard_texts())] + [(5000, None), (None, "null id"), (6000, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS file_no", "'x' AS ids")
    got, folder = stored(spark, df)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == expected(library, docs)
    ids = {r["doc_id"]: r["ids"] for r in T.read(spark, folder, with_ids=True).collect()}
    assert ids[6000] == [2] and ids[docs[3][0]] == library.encode(docs[3][1], add_special_tokens=False).ids + [2]


def test_repeated_rows(spark, library):
    docs = [(4, "same text"), (4, "same text"), (4, "same text"), (2, "other")]
    got, _ = stored(spark, spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == expected(library, docs)


def test_a_shared_id_is_dealt_over_files(spark, library):
    docs = [(None, f"text number {i}") for i in range(300)] + [(1, f"more {i}") for i in range(300)] + [(2, "end")]
    got, folder = stored(spark, spark.createDataFrame(docs, "doc_id long, text string"))
    rows = sorted(map(tuple, got.collect()), key=lambda r: r[1])
    assert [r[0] for r in rows] == [None] * 300 + [1] * 300 + [2]
    assert [r[1] for r in rows] == [sum(r[2] for r in rows[:i]) for i in range(len(rows))]
    assert sorted(r[2:] for r in rows) == sorted(r[2:] for r in expected(library, docs))
    files = spark.read.parquet(folder)
    assert files.filter("exists(doc_ids, x -> x is null)").select("file_no").distinct().count() > 1


def test_empty(spark):
    got, _ = stored(spark, spark.createDataFrame([], "doc_id long, text string"))
    assert got.count() == 0


def test_query_against_the_library(spark, library):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(map(tuple, op7_token_store(spark, SF).collect()), key=lambda r: r[1]) == expected(library, docs)
