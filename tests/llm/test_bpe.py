import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from conftest import SF
from hourcast.llm import bpe
from hourcast.llm.queries import op9_bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH),
                             special_tokens={})


def hard_texts():
    rnd = random.Random(6)
    alphabet = list("abS 's'tre'vellmd  \n\t19.,!é 　中x'_") + ["'re", "'ll", " '", "''", "\x1c", "\x85", "<|endoftext|>"]
    out = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(1500)]
    return out + ["", "a" * 5000, " " * 3000, "\n", "don't we'll I've 'sabc 's's 're're'", "'", "x'", "x's", "word " * 4000]


def test_ids_equal_the_library_on_hard_texts(spark, library):
    texts = hard_texts()
    df = spark.createDataFrame(list(enumerate(texts)) + [(-1, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in bpe.decode(spark, bpe.encode(spark, df, PATH), PATH).collect()}
    once = {r["doc_id"]: r for r in bpe.roundtrip(spark, df, PATH).collect()}
    assert once == got
    sizes = {i: len(t) for t, i in library._mergeable_ranks.items()}
    for r in got.values():                              # offsets stand where the bytes of the ids begin
        at = np.cumsum([0, *(sizes[i] for i in r["ids"])])[:-1]
        assert r["offsets"] == at.tolist()
    for i, text in enumerate(texts):
        assert got[i]["ids"] == library.encode_ordinary(text), text
        assert bytes(got[i]["decoded"]) == text.encode()
    assert got[-1]["ids"] == [] and bytes(got[-1]["decoded"]) == b"" and got[-1]["text"] is None


def test_ids_equal_the_library_for_every_code_point(library):
    import pyarrow as pa
    from hourcast.llm import _words as W
    texts = ["a" + chr(c) + "b " + chr(c) + " " + chr(c) for c in range(0x20, 0x11000) if not 0xD800 <= c < 0xE000]
    data, offsets = W.flat(pa.array(texts))
    starts = bpe.piece_starts(data, offsets)
    cache = bpe.PieceCache(lambda pieces: (bpe.merge(p, library._mergeable_ranks) for p in pieces))
    ids, n = cache.lookup(data.tobytes(), starts, np.append(starts[1:], len(data)))
    bounds = np.concatenate([[0], np.cumsum(n)])[np.searchsorted(starts, offsets)]
    for i, text in enumerate(texts):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == library.encode_ordinary(text), hex(ord(text[1]))


def test_scan_equals_the_sequential_machine():
    rng = np.random.default_rng(0)
    f = rng.choice([bpe._RESET, bpe._LETTER, bpe._OPEN_1, bpe._OPEN_2], 5000, p=[.2, .6, .1, .1]).astype(np.uint8)
    state, expected = 0, []
    for x in f:
        expected.append(state)
        state = (int(x) >> (2 * state)) & 3
    assert bpe.states_before(f).tolist() == expected


def test_long_merge_equals_short_merge():
    ranks = bpe.read_ranks(PATH)
    rnd = random.Random(8)
    for _ in range(200):
        piece = "".join(rnd.choice("theandioé1. ") for _ in range(rnd.randint(1, 60))).encode()[:64]
        assert bpe._merge_long(piece, ranks) == bpe.merge(piece, ranks)


def test_a_full_cache_starts_anew(monkeypatch, library):
    import pyarrow as pa
    from hourcast.llm import _words as W
    monkeypatch.setattr(bpe, "CACHE_PIECES", 5)
    ranks = bpe.read_ranks(PATH)
    cache = bpe.PieceCache(lambda pieces: (bpe.merge(p, ranks) for p in pieces))
    for text in ["one two three four five six", "seven one " + "y" * 100, "one eight nine ten " + "y" * 100] * 2:
        data, offsets = W.flat(pa.array([text]))
        starts = bpe.piece_starts(data, offsets)
        ids, _ = cache.lookup(data.tobytes(), starts, np.append(starts[1:], len(data)))
        assert ids.tolist() == library.encode_ordinary(text)


def test_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string, ids string")
    assert bpe.decode(spark, bpe.encode(spark, df, PATH), PATH).count() == 0
    df = spark.createDataFrame([(1, "a b", "x", b"y")], "doc_id long, text string, ids string, decoded binary")
    out = bpe.decode(spark, bpe.encode(spark, df, PATH), PATH)
    assert out.columns == ["doc_id", "text", "ids", "offsets", "decoded"] and bytes(out.first()["decoded"]) == b"a b"
    df = spark.createDataFrame([(1, "a b", "kept", 7)], "doc_id long, text string, __text string, source_text int")
    row = bpe.roundtrip(spark, df, PATH).first()
    assert (row["__text"], row["source_text"], bytes(row["decoded"])) == ("kept", 7, b"a b")


def test_offsets_with_a_gap_are_refused(library):
    vocabulary = bpe.Vocabulary(bpe.read_ranks(PATH))
    data = np.frombuffer(b"one two", np.uint8)
    ids, at, bounds = vocabulary.encode(data, np.array([0, 7]))
    assert vocabulary.decode(ids, at, bounds)[0].tobytes() == b"one two"
    with pytest.raises(ValueError):
        vocabulary.decode(ids, at + 1, bounds)


def test_two_vocabularies_in_one_session(spark, tmp_path):
    """Vocabularies that differ in a late token only do not share a cache."""
    lines = open(PATH, "rb").read().splitlines()
    cut = tmp_path / "cut.tiktoken"
    cut.write_bytes(b"\n".join(lines[:20000]))
    df = spark.createDataFrame([(1, "ascertained photographers")], "doc_id long, text string").coalesce(1)
    whole = bpe.encode(spark, df, PATH).first()["ids"]
    small = bpe.encode(spark, df, str(cut)).first()["ids"]
    ranks = bpe.read_ranks(str(cut))
    assert whole != small and small == [*bpe.merge(b"ascertained", ranks), *bpe.merge(b" photographers", ranks)]


def test_query_against_the_library(spark, library):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op9_bpe(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode_ordinary(docs[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()
