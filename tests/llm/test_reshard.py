import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from conftest import SF
from hourcast.llm import reshard
from hourcast.llm.queries import op3_flow_reshard


def test_flow_is_of_least_cost_against_enumeration():
    rnd = random.Random(5)
    for _ in range(60):
        n, m = rnd.randint(1, 3), rnd.randint(1, 3)
        supply = [rnd.randint(0, 3) for _ in range(n)]
        units = [i for i, s in enumerate(supply) for _ in range(s)]
        demand = [0] * m
        for _ in units:
            demand[rnd.randrange(m)] += 1
        cost = [[float(rnd.randint(0, 4)) for _ in range(m)] for _ in range(n)]
        flow = reshard.min_cost_flow(supply, demand, cost)
        got = sum(cost[i][j] * a for (i, j), a in flow.items())
        slots = [j for j, d in enumerate(demand) for _ in range(d)]
        best = min((sum(cost[i][j] for i, j in zip(units, p)) for p in set(itertools.permutations(slots))), default=0)
        assert got == best
        assert all(sum(a for (i, _), a in flow.items() if i == s) == supply[s] for s in range(n))
        assert all(sum(a for (_, j), a in flow.items() if j == t) == demand[t] for t in range(m))


def test_flow_moves_only_the_excess():
    flow = reshard.min_cost_flow([90, 10, 20], [30, 30, 30, 30], [[float(i != j) for j in range(4)] for i in range(3)])
    assert sum(a for (i, j), a in flow.items() if i != j) == 60
    with pytest.raises(ValueError):
        reshard.min_cost_flow([2], [1], [[0.0]])


def check(rows, docs_by_id):
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r)
    for got in by_shard.values():
        assert sorted(r["slot"] for r in got) == list(range(len(got)))
    return {s: sum(r["size"] for r in got) for s, got in by_shard.items()}


def test_query_keeps_every_row_and_sizes_are_near_equal(spark):
    out = op3_flow_reshard(spark, SF).collect()
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in out) == sorted(docs)
    for r in out:
        raw = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
    sizes = check(out, docs)
    largest = max(r["size"] for r in out)
    assert len(sizes) == 24 and max(sizes.values()) - min(sizes.values()) <= largest


def test_edge_rows_and_shards_that_stay(spark, tmp_dir):
    rows = [(i, "x" * (i % 7) if i % 11 else None, i) for i in range(200)] + [(5, "same", 1)] * 3 + [(None, None, None), (999, "y" * 50_000, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, slot int")
    got = reshard.reshard(spark, df, F.lit(0), 1, 3).withColumn("size", F.octet_length(F.coalesce("text", F.lit(""))) + 8).collect()
    assert len(got) == len(rows)
    check(got, None)
    # equal shards of equal capacity move nothing, and no file is written
    even = spark.createDataFrame([(i, "abc") for i in range(40)], "doc_id long, text string")
    folder = f"{tmp_dir}/even"
    out = reshard.reshard(spark, even, F.col("doc_id") % 2, 2, 2, folder=folder)
    assert out.filter(F.col("shard") != F.col("doc_id") % 2).count() == 0 and out.count() == 40
    assert not spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
        "pathGlobFilter", "*.parquet").load(folder).count()


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert reshard.reshard(spark, df, F.lit(0), 2, 3).count() == 0
