import hashlib
import random
import re
from collections import Counter

import pytest

from hourcast.llm import substring as S


def brute(rows, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(rows, words):
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i:i + window])] > 1
                for j in range(i, i + window)}
        out.append((d, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=str)


def run(spark, rows, window):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "7 AS n_words", "'q' AS first", "1 AS h1")
    out = S.remove_repeats(spark, df, window=window)
    assert out.columns == ["doc_id", "text", "first", "h1", "n_words", "n_removed", "kept_text"]
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in out.collect()), key=str)


def cases(seed, window):
    rnd = random.Random(seed)
    fresh = lambda n: [f"{rnd.choice('aäB')}{rnd.randint(0, 400)}" for _ in range(n)]
    shared = [fresh(window + extra) for extra in (-1, 0, 1, 30)]
    rows = []
    for d in range(60):
        w = fresh(rnd.randint(0, 80))
        for _ in range(rnd.randint(0, 2)):
            at = rnd.randint(0, len(w))
            w[at:at] = rnd.choice(shared)
        rows.append((d, rnd.choice([" ", "\n", " \t "]).join(w)))
    rows += [(100, "x " * 200), (101, "a b " * 50), (102, None), (103, ""), (104, "  "), (None, rows[0][1]),
             (3, rows[3][1]), (3, "another text of the same id"), (105, " ".join(fresh(40_000)))]
    return rows + [(200 + i, rows[5][1]) for i in range(30)]


@pytest.mark.parametrize("window", [3, 16, 35])
def test_against_brute_force(spark, window):
    rows = cases(window, window)
    assert run(spark, rows, window) == brute(rows, window)


def test_no_repeat_is_lost_by_a_full_sketch_or_early_settling(spark, monkeypatch):
    monkeypatch.setattr(S, "sketch_width_bits", lambda *a: 4)     # nearly every cell is full
    rows = cases(9, 5)
    assert run(spark, rows, 5) == brute(rows, 5)


def test_repeated_rows_only(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(1, text)] * 40 + [(None, None)] * 3
    assert run(spark, rows, 35) == brute(rows, 35)


def test_rows_without_an_id_are_told_apart_by_text(spark):
    rnd = random.Random(12)
    rows = [(None, " ".join(f"w{rnd.randint(0, 30)}" for _ in range(rnd.randint(0, 40)))) for _ in range(80)]
    rows += [(0, rows[0][1]), (None, None), (None, rows[1][1])]
    assert run(spark, rows, 3) == brute(rows, 3)


def test_empty(spark):
    assert run(spark, [], 35) == []


def test_query_digest(spark):
    from conftest import SF
    from hourcast.llm.queries import op10_substring_dedup
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    expected = [(d, n, g, hashlib.sha256(t.encode()).hexdigest()) for d, n, g, t in brute(docs, 35)]
    assert sorted(map(tuple, op10_substring_dedup(spark, SF).collect())) == sorted(expected)
