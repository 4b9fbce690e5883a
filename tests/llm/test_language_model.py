import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourcast.llm import language_model as L
from hourcast.llm.queries import op8_lm_score

SMALL = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + [None]


def brute(rows, learned):
    c = Counter(t for d, text in rows if learned(d) for t in tokens(text))
    n, v = sum(c.values()), len(c)
    base = lambda ts: sum(math.log10((c[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts)
    return [(d, len(tokens(x)), sum(t in c for t in tokens(x)), n, base(tokens(x))) for d, x in rows]


def held(d):
    return zlib.crc32(str(d).encode()) % 5 == 1


def test_query_counts_and_base_score(spark, monkeypatch):
    monkeypatch.setattr(L, "HEAD_WORDS", 500)          # most words take the join
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = {r["doc_id"]: r for r in op8_lm_score(spark, SMALL).collect()}
    expected = brute(docs, lambda d: not held(d))
    assert len(got) == len(expected)
    for d, n, known, total, base in expected:
        r = got[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held(d), n, known, total)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and r["score"] < 0
    # the model is better than the unigram on texts it did not learn from
    out = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out) * 0.97


def test_class_distributions_are_normalised_and_follow_the_counts():
    rng = np.random.default_rng(1)
    follow = rng.integers(0, L.CLASSES, L.CLASSES)
    one = np.arange(L.CLASSES)
    code = (np.zeros_like(one) * L.CLASSES + one) * L.CLASSES + follow
    table = L.train(code, np.full(L.CLASSES, 100.0))
    assert np.allclose((10.0 ** table.astype(float)).sum(2), 1, atol=1e-4)
    learned = 10.0 ** table[0, one, follow].astype(float)
    assert np.median(learned) > 0.3


def test_words_of_all_classes_make_a_distribution(spark, monkeypatch):
    """Over every known word, the end and the unknown words the probabilities add up to one."""
    monkeypatch.setattr(L, "PASSES", 30)
    train = " ".join(f"w{i % 90}{'abc'[i % 3]}" for i in range(4000))
    vocabulary = sorted(set(train.split()))
    # texts of one word differ in that word and in the end behind it only
    import pyarrow as pa
    unknown = {}
    for i in range(20_000):
        s = int(L.Tokens(pa.array([f"u{i}"])).suffix[0])
        unknown.setdefault(s, f"u{i}")
    assert len(unknown) == L.SUFFIX_CLASSES or len(unknown) > 8
    df = spark.createDataFrame([(0, train)] + [(i + 1, w) for i, w in enumerate(vocabulary)], "doc_id long, text string")
    seen = {}
    real = L.train
    monkeypatch.setattr(L, "train", lambda *a: seen.setdefault("table", real(*a)))
    rows = {r["doc_id"]: r["score"] for r in L.lm_scores(spark, df, F.col("doc_id") == 0).collect()}
    table = seen["table"].astype(float)
    # P(first word) = score - log P(end | start, class of the word)
    from hourcast.llm import _words as W
    counts = Counter(vocabulary)
    counts.update(train.split())
    own = sorted(vocabulary, key=lambda w: (-train.split().count(w), int(W.Words(pa.array([w])).hashes(True).view(np.int64)[0])))
    common = np.sort(np.array([W.Words(pa.array([w])).hashes(True)[0] for w in own[:L.COMMON]], np.uint64))
    total = 0.0
    for i, w in enumerate(vocabulary):
        cls = int(L.Tokens(pa.array([w])).classes(common)[0])
        total += 10 ** (rows[i + 1] - table[L.END_CLASS, cls, L.END_CLASS])
    end = 10 ** table[L.END_CLASS, L.END_CLASS, L.END_CLASS]
    # what is left is the unknown words' share of every open class
    suffix = {}
    for w in vocabulary:
        cls = int(L.Tokens(pa.array([w])).classes(common)[0])
        if cls >= L.COMMON:
            suffix[cls] = suffix.get(cls, 0) + train.split().count(w) + 0.5
    rest = sum(10 ** table[L.END_CLASS, L.END_CLASS, c] * 0.5 / (suffix.get(c, 0) + 0.5)
               for c in range(L.COMMON, L.COMMON + L.SUFFIX_CLASSES))
    # classes of their own that no word took have no word to give their share to
    unused = sum(10 ** table[L.END_CLASS, L.END_CLASS, c] for c in range(len(common), L.COMMON))
    assert total + end + rest + unused == pytest.approx(1, abs=1e-3)


def test_nulls_repeats_long_texts_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(L, "PASSES", 10)
    rows = [(1, "a b a"), (1, "a b a"), (None, None), (2, ""), (3, "Q " * 50_000), (4, "never seen words")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    got = L.lm_scores(spark, df, F.coalesce(F.col("doc_id"), F.lit(0)) != 4).collect()
    expected = brute(rows, lambda d: d != 4)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    for r, e in zip(sorted((tuple(r) for r in got), key=key), sorted(expected, key=key)):
        assert r[:4] == e[:4] and math.isclose(r[4], e[4], rel_tol=1e-9)
    assert L.lm_scores(spark, df.filter("false"), F.lit(True)).count() == 0
    nothing = L.lm_scores(spark, df, F.lit(False)).collect()
    assert len(nothing) == 6 and all(r["n_known"] == 0 and r["train_tokens"] == 0 for r in nothing)
