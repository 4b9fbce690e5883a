"""Drifting documents, sketches that are merged, bucketed tables."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from hourcast.operators import sketches as S
from hourcast.plans.store_queries import bucketed_pair
from hourcast.sinks.bucketed import buckets_for
from hourcast.sources.drifting import drifting_hours, drifting_report, read_lines
from tests.conftest import SF


# --- documents --------------------------------------------------------------------------

def doc(regions, **extra):
    return json.dumps({"regions": regions, **extra})


def entry(region, times, temps, **extra):
    return {"region": region, "payload": {"hourly": {"time": times, "temperature_2m": temps}, **extra}}


DOCS = [
    (doc([entry("a", ["2024-01-01T00:00", "2024-01-01T01:00"], [1, 2.5])], _meta={"x": 1}), ["fine"]),
    (doc([entry("b", ["2024-01-01T00:00"], ["3.5"], more=[1, {"z": None}])], version=7), ["fine"]),
    (doc([entry("c", ["2024-01-01T00:00", "bad", "2024-01-01T02:00"], [None, 1.0, "warm"])]), ["fine"]),
    (doc([entry("d", ["2024-01-01T00:00", "2024-01-01T01:00"], [9.0])]), ["arrays of unequal length"]),
    (doc([entry(None, ["2024-01-01T00:00"], [1.0]), entry(" ", [], []), {"region": "e"}, 5]),
     ["region without name"] * 2 + ["region without arrays", "region without name"]),
    (doc([]), ["no regions"]), (doc("text"), ["no regions"]), ("{}", ["no regions"]), ("[1, 2]", ["no regions"]),
    ("null", ["no regions"]), ('{"regions": [', ["broken JSON"]), ("not json at all", ["broken JSON"]),
    ("é中", ["broken JSON"]), ("   ", []), (doc([entry("f", {"0": 1}, "x")]), ["region without arrays"])]
HOURS = [("a", 0, 1.0), ("a", 1, 2.5), ("b", 0, 3.5), ("d", 0, 9.0)]


def hours_of(lines):
    return sorted((r.region, r.time.hour, r.temperature_2m) for r in drifting_hours(lines).collect())


def states_of(lines):
    return {r.status: r.n for r in drifting_report(lines).collect()}


@pytest.mark.parametrize("whole_files", [False, True])
def test_documents_of_every_shape(spark, tmp_dir, whole_files):
    if whole_files:
        for i, (text, _) in enumerate(DOCS):
            with open(os.path.join(tmp_dir, f"{i}.json"), "w") as f:
                f.write(text)
    else:
        with open(os.path.join(tmp_dir, "all.json"), "w") as f:
            f.write("\n".join(text for text, _ in DOCS))
    lines = read_lines(spark, tmp_dir, whole_files)
    assert hours_of(lines) == HOURS
    want = [s for _, states in DOCS for s in states]
    assert states_of(lines) == {s: want.count(s) for s in want}


def test_no_documents(spark, tmp_dir):
    open(os.path.join(tmp_dir, "empty.json"), "w").close()
    lines = read_lines(spark, tmp_dir)
    assert hours_of(lines) == [] and states_of(lines) == {}


# --- sketches -----------------------------------------------------------------------------

def values(spark, seed, days=6, n=3000):
    rnd = random.Random(seed)
    rows = [(d, rnd.choice(["hot", "hot", "a"]), rnd.gauss(100 * d, 30), rnd.randrange(900)) for d in range(days)
            for _ in range(n)] + [(0, "a", None, None), (1, "none", None, None)]
    return spark.createDataFrame(rows, "day int, k string, v double, who int")


def within_bounds(df, sketch, keys):
    got = {tuple(r[k] for k in keys): r for r in sketch.select(
        *keys, "n_rows", S.quantile(0.5).alias("p50"), S.quantile(0.9).alias("p90"),
        S.distinct_estimate().alias("who")).collect()}
    rows = {}
    for r in df.collect():
        rows.setdefault(tuple(r[k] for k in keys), []).append(r)
    assert got.keys() == rows.keys()
    for key, mine in rows.items():
        v = sorted(r.v for r in mine if r.v is not None)
        assert got[key].n_rows == len(mine)
        if not v:
            assert got[key].p50 is None and got[key].who == 0
            continue
        for share, q in ((0.5, got[key].p50), (0.9, got[key].p90)):
            assert abs(sum(x <= q for x in v) / len(v) - share) <= 0.0333
        exact = len({r.who for r in mine if r.who is not None})
        assert abs(got[key].who / exact - 1) <= 0.065


def test_sketches_of_days_and_of_ranges(spark):
    df = values(spark, 1)
    daily = S.sketched(df, ["day", "k"], "v", "who")
    within_bounds(df, daily, ["day", "k"])
    within_bounds(df, S.merged(daily, ["k"]), ["k"])
    within_bounds(df.filter("day < 3"), S.merged(daily.filter("day < 3"), ["k"]), ["k"])


def test_a_corrected_day_is_sketched_again(spark, tmp_dir):
    df = values(spark, 2)
    path = os.path.join(tmp_dir, "sketches")
    S.sketched(df, ["day", "k"], "v", "who").write.partitionBy("day").parquet(path)
    mended = df.filter("day <> 4").unionByName(values(spark, 3).filter("day = 4").withColumn("v", F.col("v") * 9))
    (S.sketched(mended.filter("day = 4"), ["day", "k"], "v", "who").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path))
    within_bounds(mended, S.merged(spark.read.parquet(path), ["k"]), ["k"])


# --- bucketed tables --------------------------------------------------------------------------

def test_bucketed_sides_are_not_shuffled(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        energy, weather = bucketed_pair(spark, SF, ["region", "ts"])
        join = energy.join(weather.drop("day"), ["region", "ts"])
        daily = [bucketed_pair(spark, SF, ["day", "region"], "users")[i].groupBy("day", "region").count() for i in (0, 1)]
        mart = daily[0].join(daily[1].withColumnRenamed("count", "n"), ["day", "region"], "left")
        for df in (join, mart):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
            assert df.count() > 0
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_numbers_of_buckets_divide_each_other():
    sizes = [buckets_for(n, per_bucket=10) for n in (0, 79, 81, 200, 100_000)]
    assert sizes == [8, 8, 16, 32, 16384] and all(max(a, b) % min(a, b) == 0 for a in sizes for b in sizes)
