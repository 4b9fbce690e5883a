import random

import numpy as np
import xxhash

from conftest import SF
from hourcast.llm import simhash as S
from hourcast.llm.queries import op5_simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_fingerprint(text, k=4):
    w = (text or "").translate(LOWER).encode().split()
    if not w:
        return 0
    runs = [b" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(r, seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, bits=4):
    """fps: list of (id, fingerprint) -> ids' components, by comparing all pairs."""
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= bits:
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(fps):
        r = root(i)
        known = [x for x in (least.get(r), d) if x is not None]
        least[r] = min(known) if known else None
    return [least[root(i)] for i in range(len(fps))]


def test_fingerprint_definition(monkeypatch):
    rnd = random.Random(1)
    texts = [" ".join(rnd.choice(["Aa", "b", "Ç", "dd"]) for _ in range(rnd.randint(0, 30))) for _ in range(60)]
    for t in [*texts, None, "", " \n", "one", "ONE two three"]:
        assert S.fingerprint(t) == slow_fingerprint(t)
    long = " ".join(str(i % 977) for i in range(70_000))
    assert S.fingerprint(long) == slow_fingerprint(long)


def test_block_orders_lose_no_pair():
    rnd = random.Random(2)
    for _ in range(300):
        differing = set(rnd.sample(range(64), 4))
        assert any(not differing & set(order[:depth].tolist()) for order, depth in S.block_orders())


def test_trie_against_all_pairs():
    rng = np.random.default_rng(3)
    for n, spread in ((200, 3), (400, 1), (1500, 5), (3000, 2)):
        centre = rng.integers(0, 2 ** 63, max(1, n // 40), dtype=np.uint64)
        keys = rng.choice(centre, n)
        for _ in range(spread):
            keys = keys ^ (np.uint64(1) << rng.integers(0, 40, n).astype(np.uint64))
        keys = np.unique(keys)
        roots = S.trie_links(keys, 10)
        apart = np.bitwise_count(keys[:, None] ^ keys[None, :]) <= 4
        apart &= (keys[:, None] >> np.uint64(54)) == (keys[None, :] >> np.uint64(54))
        seen = np.arange(len(keys))
        while True:                                     # smallest index reachable
            new = np.where(apart, seen[None, :], len(keys)).min(1)
            if (new == seen).all():
                break
            seen = new
        _, a = np.unique(seen, return_inverse=True)
        _, b = np.unique(roots, return_inverse=True)
        assert len(set(zip(a.tolist(), b.tolist()))) == a.max() + 1 == b.max() + 1


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int")
    return [tuple(r) for r in S.near_duplicates(spark, df).collect()]


def expected(rows):
    fps = [(r[0], slow_fingerprint(r[1])) for r in rows]
    return [(d, f"{f:016x}", c) for (d, f), c in zip(fps, brute_components(fps))]


def key(r):
    return tuple((x is None, x if x is not None else 0) for x in r)


def test_components_of_copies_near_copies_nulls_and_repeated_rows(spark):
    rnd = random.Random(4)
    base = [[f"w{rnd.randint(0, 500)}" for _ in range(60)] for _ in range(12)]
    rows = []
    for i in range(160):
        words = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 2])):
            words[rnd.randrange(60)] = f"x{rnd.randint(0, 9)}"
        rows.append((1000 - i, " ".join(words), "z", 1))
    rows += [(5, None, None, None), (6, "", None, None), (7, " ", None, None), (3, rows[0][1], "z", 1),
             (3, rows[0][1], "z", 1), (None, rows[1][1], "z", 1), (None, "alone of null id", "z", 1)]
    assert sorted(run(spark, rows), key=key) == sorted(expected(rows), key=key)


def test_chain_of_links_reaches_its_end(spark):
    # a path of fingerprints, each one bit from the next, through edges only
    path = [0]
    for bit in range(40):
        path.append(path[-1] | 1 << bit)
    df = spark.createDataFrame([(f,) for f in path], "fp long")
    got = {r["node"]: r["root"] for r in S.components(
        spark, S.links(df), f"{spark.sparkContext.getCheckpointDir()}/chain-test").collect()}
    assert set(got) == set(path) and set(got.values()) == {0}


def test_keep_one_row_of_each_component(spark):
    """Rows of one id, or of none, in different components all have their own keeper."""
    rnd = random.Random(6)
    text = lambda: " ".join(f"w{rnd.randint(0, 900)}" for _ in range(50))
    a, b, c, d, e = (text() for _ in range(5))
    rows = [(5, a), (5, b), (5, c), (3, c), (7, c), (None, c), (None, d), (None, e), (None, e),
            (0, d), (9, a), (4, None), (6, ""), (None, None), (8, "alone"), (8, "alone")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS fp", "2 AS first")
    out = S.keep_one(spark, df)
    assert out.columns == df.columns
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    assert got == sorted([(5, a), (5, b), (3, c), (0, d), (None, e), (4, None), (8, "alone")], key=str)


def test_empty(spark):
    assert run(spark, []) == []
    assert S.keep_one(spark, spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in op5_simhash(spark, SF).collect())
    assert got == sorted(expected(docs))
