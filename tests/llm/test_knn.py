import math
import random

from pyspark.sql import functions as F

from hourcast.llm import knn


def brute(rows, k, queries):
    ok = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in ok:
        if queries(q):
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q)[:k]
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)}
    return out


def run(spark, rows, k=4):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, id string")
    got = knn.top_k(spark, df, F.col("id") % 5 == 0, k, component=lambda x: F.floor(x * 64))
    assert [(f.name, f.dataType.simpleString()) for f in got.schema.fields] == [
        ("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    return {tuple(r) for r in got.collect()}


def test_against_brute_force_with_ties_and_invalid_vectors(spark, monkeypatch):
    monkeypatch.setattr(knn, "CHUNK", 16)
    monkeypatch.setattr(knn, "BLOCK", 4)
    rnd = random.Random(3)
    grid = lambda: [rnd.randint(-4, 4) / 4 for _ in range(3)]  # noqa: E731  many equal scores
    rows = [(i, grid()) for i in range(150)] + [(200, [1.0]), (205, []), (206, None), (210, [1.0, None, 0.0]),
                                                (215, [1.0, float("nan"), 0.0]), (220, [float("inf"), 0.0, 0.0]),
                                                (None, [1.0, 1.0, 1.0])]
    assert run(spark, [(i, v, "x") for i, v in rows]) == brute(rows, 4, lambda i: i % 5 == 0)


def test_one_crowded_cell_and_fewer_candidates_than_k(spark):
    rows = [(i, [0.5, 0.5]) for i in range(40)]
    assert run(spark, [(i, v, "x") for i, v in rows]) == brute(rows, 4, lambda i: i % 5 == 0)
    rows = [(0, [0.5, 0.5]), (1, [1.0, 0.0])]
    assert run(spark, [(i, v, "x") for i, v in rows]) == brute(rows, 4, lambda i: i % 5 == 0)


def test_empty(spark):
    assert run(spark, []) == set()
    assert run(spark, [(5, None, "x")]) == set()
    assert run(spark, [(5, [1.0], "x")]) == set()


def test_every_row_of_a_repeated_query_id_has_its_own_result(spark, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK", 1)          # blocks of equal ids
    others = [(i, [i / 8, 1 - i / 8]) for i in range(1, 40) if i % 5]
    for twice in ([0.5, 0.5], [-0.5, 0.25]):      # equal vectors, and different ones
        pair = [(5, [0.5, 0.5]), (5, twice)]
        df = spark.createDataFrame(others + pair, "vec_id long, embedding array<float>")
        got = knn.top_k(spark, df, F.col("id") % 5 == 0, 4, component=lambda x: F.floor(x * 64)).collect()
        want = [r for row in pair for r in brute(others + [row], 4, lambda i: i == 5)]
        assert sorted(tuple(r) for r in got) == sorted(want)


def test_many_pivots_bundles_and_parts(spark, monkeypatch):
    """Every size at its smallest: each block meets each chunk that is sent once."""
    for name, value in (("CHUNK", 4), ("BLOCK", 2), ("BUNDLE", 1), ("PART_CHUNKS", 2)):
        monkeypatch.setattr(knn, name, value)
    monkeypatch.setattr(knn, "n_pivots", lambda rows: 40)
    rnd = random.Random(6)
    rows = [(i, [rnd.gauss(0, 1) + 4 * (i % 3) for _ in range(4)]) for i in range(160)]
    assert run(spark, [(i, v, "x") for i, v in rows]) == brute(rows, 4, lambda i: i % 5 == 0)


def test_pruning_is_reported_and_pivots_grow(spark):
    assert [knn.n_pivots(n) for n in (0, 50_000, 5_000_000, 10 ** 12)] == [16, 16, 158, 512]
    rnd = random.Random(7)
    rows = [(i, [(20.0 if i < 400 else 0.1) * rnd.random() for _ in range(2)]) for i in range(4000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1)
    stats = {}
    knn.top_k(spark, df, F.col("id") % 5 == 0, 4, stats=stats).collect()
    assert 0 < stats["sent"] < stats["pairs"] and stats["pivots"] == 16
