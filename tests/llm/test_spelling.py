"""Spelling variants against a brute-force version; filters lose nothing."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from hourcast.llm import _frames, spelling as S

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_vocabulary(docs):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            w = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                at = h % len(w)
                w = w[:at] + w[at + 1:]
            n[w] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(words):
    others = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w, vs in others.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(others[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def words_with_variants(seed, n=60):
    rng = random.Random(seed)
    letters = "abllé×ÿz"
    out = {}
    for _ in range(n):
        w = "".join(rng.choices(letters, k=rng.randrange(7, 10)))
        out[w] = rng.choice([2, 3, 25, 260, 2700, 30000])
        for _ in range(4):
            i = rng.randrange(len(w))
            v = rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i:],
                            w[:i] + rng.choice(letters) + w[i + 1:]])
            if len(v) >= 7:
                out.setdefault(v, rng.choice([2, 3, 20, 250]))
    return out


def run(spark, words, **kw):
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    return sorted(map(tuple, S.group_variants(spark, df, **kw).collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    words = words_with_variants(seed)
    want = brute(words)
    assert sum(r[1] is not None for r in want) > 20 and any(r[1] != r[2] for r in want if r[1])
    assert run(spark, words) == want


def test_several_rounds_and_shards(spark):
    """Filters of 4 KB a round: lengths in several rounds, and shards of one length."""
    rng = random.Random(9)
    words = {"".join(rng.choices("abcdefg", k=8)): 2 for _ in range(4000)}
    plan = S.shard_plan(Counter(map(len, words)), 4096)
    assert len(plan) > 1 and plan[0][0][2] > 1
    assert run(spark, words, round_bytes=4096) == run(spark, words)


def test_roots_of_long_chains_and_hot_roots(spark, monkeypatch):
    """Forms that follow each other six times, and many words with one root."""
    names = ["a" * (14 - i) + "b" * i for i in range(7)]
    words = {v: 2 * 10 ** i for i, v in enumerate(names)}
    for c in "cdefghijklmnopqrstuvwxyz":
        words[names[-1][:-1] + c] = 2
    plain = _frames.hot_parts
    monkeypatch.setattr(S, "hot_parts", lambda d, key, least=2: plain(d, key, 2))
    got = run(spark, words)
    assert got == brute(words)
    assert {r[2] for r in got if r[0] in names} == {names[-1]}


def test_vocabulary(spark):
    rng = random.Random(4)
    pool = ["Letters", "straße", "ÉCOLEs×", "abcdefgh", "Abcdefgh", "x" * 5000, "shorter", "a1bcdefgh", "naïveté"]
    docs = [(i, " ".join(rng.choices(pool, k=30))) for i in range(200)]
    docs += [(None, "Letters Letters"), (7, None), (8, ""), (8, ""), (9, "1234567 \0\n")]
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, word string")
    assert {r.word: r.n for r in S.vocabulary(df).collect()} == brute_vocabulary(docs)


def test_empty_and_single(spark):
    assert run(spark, {}) == []
    assert run(spark, {"abcdefgh": 5}) == [("abcdefgh", None, "abcdefgh", 5, 0, None)]
    with pytest.raises(ValueError):
        run(spark, {"abcdefgh": 5}, ratio=1)


def test_hashes_of_edits_are_those_of_the_edited_words():
    cp = S._matrix(["abcdefg", "ÿéàüöäß"], 7)
    letters = np.array([ord(c) for c in "aqÿ"], np.uint32)
    dels = S.deletion_hashes(cp)
    at, reps = S.replacement_hashes(cp, letters)
    for r, w in enumerate(["abcdefg", "ÿéàüöäß"]):
        for i in range(7):
            assert dels[r, i] == S.word_hashes(S._matrix([w[:i] + w[i + 1:]], 6))[0]
    assert len(at)
    for flat, h in zip(at, reps):
        r, i, c = flat // 21, flat // 3 % 7, flat % 3
        w = ["abcdefg", "ÿéàüöäß"][r]
        assert chr(letters[c]) > w[i]
        assert h == S.word_hashes(S._matrix([w[:i] + chr(letters[c]) + w[i + 1:]], 7))[0]


def test_filters_hold_every_word_and_few_others(spark):
    rng = random.Random(3)
    words = sorted({"".join(rng.choices("abcdefghij", k=9)) for _ in range(20000)})
    df = spark.createDataFrame([(w, 9) for w in words], "word string, length int")
    shards = S.shard_plan({9: len(words)})[0]
    bits = S.filters(df, shards)[9, 0]
    held = lambda ws: len(S._holds(bits, *S._cells(S.word_hashes(S._matrix(ws, 9)), 1, shards[0][3])[1:]))
    assert held(words) == len(words)
    other = ["".join(rng.choices("klmnopqrst", k=9)) for _ in range(20000)]
    assert held(other) < 0.01 * len(other)
