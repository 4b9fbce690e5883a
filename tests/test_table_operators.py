"""Observed gates, pending days, global ranks, subtotals, multisets, measured windows."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from hourcast.operators import cells as C
from hourcast.operators import quality as Q
from hourcast.operators.asof import asof_join
from hourcast.operators.multiset import difference, except_all, gate_equal, intersect_all
from hourcast.operators.observed import Watch, ingest_gate, not_null_gate, range_gate, rowcount_gate
from hourcast.operators.ranges import range_stats
from hourcast.operators.ranks import global_ranks
from hourcast.operators.rollups import cube_sets, rollup_sets, subtotals
from hourcast.operators.windows import lag_delta, rolling_mean
from hourcast.plans import daily
from hourcast.plans.registry import raw_pair
from hourcast.sinks import tables as sink
from tests.conftest import SF


# --- gates on the write ---------------------------------------------------------------

def weather(spark, temps):
    return spark.createDataFrame([(f"2024-01-0{i % 9 + 1}", t) for i, t in enumerate(temps)],
                                 "day string, temperature_2m double")


def test_a_gate_stops_the_publish_and_leaves_no_files(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    gates = [range_gate("temperature_2m", -40, 45), not_null_gate(["day"])]
    sink.write_table(weather(spark, [1.0, 2.0, None]), path, "day", gates=gates)
    for bad in ([50.0, 1.0], [float("nan")]):
        with pytest.raises(Q.GateFailed, match="temperature_2m within") as e:
            sink.write_table(weather(spark, bad), path, "day", gates=gates)
        assert e.value.metrics["outside_temperature_2m"] == 1 and e.value.metrics["n_rows"] == len(bad)
    assert sorted(r.temperature_2m or 0 for r in sink.read(spark, path).collect()) == [0, 1.0, 2.0]
    assert len(os.listdir(os.path.join(path, "data"))) == 1


def test_rowcount_and_empty_writes(spark, tmp_dir):
    path = os.path.join(tmp_dir, "n")
    draft = sink.draft_table(weather(spark, [1.0] * 7), path, gates=[rowcount_gate(7)])
    assert draft.metrics == {"n_rows": 7} and not sink.table_exists(spark, path)
    with pytest.raises(Q.GateFailed, match="row count == 8"):
        sink.write_table(weather(spark, [1.0] * 7), path, gates=[rowcount_gate(8)])
    sink.write_table(weather(spark, []), path, gates=[rowcount_gate(0), range_gate("temperature_2m", 0, 1)])
    assert sink.read(spark, path).count() == 0


def test_the_gate_reads_the_batch_once(spark, tmp_dir):
    """The rows pass a counter once for a gated write."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    rows = weather(spark, [1.0] * 50).mapInArrow(count, "day string, temperature_2m double")
    sink.write_table(rows, os.path.join(tmp_dir, "once"), gates=[range_gate("temperature_2m", 0, 2)])
    assert seen.value == 50


def test_ingest_gate_observes_the_text(spark, tmp_dir):
    text = spark.createDataFrame([("t", "1.0"), ("", "2.0"), ("t", "x")], "time string, temperature_2m string")
    for gate, message in ((ingest_gate(min_rows=4), "only 3"), (ingest_gate(min_rows=1), "have no time")):
        watch = Watch(text, [gate])
        watch.df.write.parquet(os.path.join(tmp_dir, message.replace(" ", "")))
        with pytest.raises(Q.GateFailed, match=message):
            watch.check()


# --- days that stay pending -----------------------------------------------------------------

def test_a_spoiled_correction_blocks_runs_of_other_days(spark, tmp_dir):
    _, raw = raw_pair(spark, SF)
    on = lambda day: raw.filter(F.col("time").cast("date") == F.lit(day).cast("date"))
    one, two = on("2024-01-01"), on("2024-01-02")
    wh = os.path.join(tmp_dir, "correction")
    lay = daily.Layout(wh)
    daily.run(spark, wh, weather=one)
    good = sorted(map(tuple, sink.read(spark, lay.mart_weather_daily).collect()))
    for batch in (one.withColumn("temperature_2m", F.lit(50.0)), two):
        with pytest.raises(Q.GateFailed, match="temperature_2m within"):
            daily.run(spark, wh, weather=batch)
    assert daily.pending_days(spark, lay) == ["2024-01-01", "2024-01-02"]
    assert sorted(map(tuple, sink.read(spark, lay.mart_weather_daily).collect())) == good
    # a run over everything sees it too
    with pytest.raises(Q.GateFailed):
        daily.run(spark, wh, weather=two, incremental=False)
    daily.run(spark, wh, weather=one)
    assert daily.pending_days(spark, lay) == []
    assert sink.read(spark, lay.mart_weather_daily).count() == 2


def test_a_run_that_dies_after_loading_is_taken_up_by_the_next(spark, tmp_dir, monkeypatch):
    _, raw = raw_pair(spark, SF)
    on = lambda day: raw.filter(F.col("time").cast("date") == F.lit(day).cast("date"))
    wh = os.path.join(tmp_dir, "dies")

    def dies(*a, **k):
        raise OSError("executor lost")
    with monkeypatch.context() as m:
        m.setattr(daily, "stage", dies)
        with pytest.raises(OSError):
            daily.run(spark, wh, weather=on("2024-01-01"))
    daily.run(spark, wh, weather=on("2024-01-02"))
    days = {str(r.day) for r in sink.read(spark, daily.Layout(wh).fact).select("day").collect()}
    assert days == {"2024-01-01", "2024-01-02"}


# --- ranks over a whole table ------------------------------------------------------------------

@pytest.mark.parametrize("ranges", [1, 3, 17])
@pytest.mark.parametrize("n", [0, 1, 7, 400])
def test_global_ranks_equal_sparks_window(spark, ranges, n):
    rnd = random.Random(n)
    rows = [(i, rnd.choice([None, 1.5, 1.5, 1.5, 2.0, float("nan"), rnd.random()]), rnd.choice("ab")) for i in range(n)]
    df = spark.createDataFrame(rows, "id int, v double, k string")
    plain = Window.orderBy("v")
    full = Window.orderBy("v", "id", "k")
    want = df.select("*", F.rank().over(plain).alias("r"), F.percent_rank().over(plain).alias("p"),
                     F.row_number().over(full).alias("n"), F.ntile(10).over(full).alias("t"))
    got = global_ranks(df, ["v"], rank="r", percent="p", row_number="n", tile="t", ranges=ranges)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_global_ranks_need_no_single_partition(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("v"))
    got = global_ranks(df, ["v"], ranges=8)
    got.collect()
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()


# --- subtotals and multisets ---------------------------------------------------------------------

def test_subtotals_tell_null_groups_from_totals(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", None, 7), (None, 1, None), (None, 1, 2)], "k string, d int, v long")
    got = {(r.k, r.d, r.grouping_id): (r.n_rows, r.sum_v, r.min_v, r.max_v)
           for r in subtotals(df, ["k", "d"], cube_sets(["k", "d"]), "v").collect()}
    assert got == {("a", 1, 0): (1, 5, 5, 5), ("a", None, 0): (1, 7, 7, 7), (None, 1, 0): (2, 2, 2, 2),
                   ("a", None, 1): (2, 12, 5, 7), (None, None, 1): (2, 2, 2, 2),
                   (None, 1, 2): (3, 7, 2, 5), (None, None, 2): (1, 7, 7, 7), (None, None, 3): (4, 14, 2, 7)}
    assert rollup_sets(["k", "d"]) == [["k", "d"], ["k"], []]
    assert subtotals(df.filter("false"), ["k"], [["k"]], "v").collect() == []


def test_multisets_count_repeated_and_null_rows(spark):
    rnd = random.Random(2)
    make = lambda: [(rnd.choice([None, 1, 2]), rnd.choice([None, float("nan"), 0.5])) for _ in range(60)]
    a, b = make(), make()
    key = lambda r: tuple(str(x) for x in r)
    ca, cb = Counter(map(key, a)), Counter(map(key, b))
    fa, fb = (spark.createDataFrame(x, "k int, v double") for x in (a, b))
    found = lambda df: {key(r[:2]): r.n for r in df.collect()}
    assert found(except_all(fa, fb)) == dict(ca - cb) and found(intersect_all(fa, fb)) == dict(ca & cb)
    assert {key(r[:2]): (r.n_left, r.n_right) for r in difference(fa, fb).collect()} == \
        {k: (ca[k], cb[k]) for k in ca | cb if ca[k] != cb[k]}
    gate_equal(fa, fa.repartition(3).select("v", "k"))
    with pytest.raises(Q.GateFailed, match="rows differ"):
        gate_equal(fa, fb)
    with pytest.raises(ValueError):
        difference(fa, fb.withColumn("v", F.lit("x")))


# --- shapes chosen by measuring -----------------------------------------------------------------------

def bursts(spark):
    """A long series with most of its rows in two seconds, and short ones."""
    hot = spark.range(3000).select(F.when(F.col("id") < 100, F.col("id") * 86400).otherwise(
        F.lit(50 * 86400 + 7)).alias("sec"), F.col("id").alias("v"), F.lit("hot").alias("region"))
    hot = hot.withColumn("micro", F.when(F.col("v") < 100, 0).otherwise(F.col("v") * 600))
    cold = spark.range(200).select((F.col("id") * 3600).alias("sec"), F.col("id").alias("v"),
                                   F.concat(F.lit("c"), F.col("id") % 3).alias("region"), F.lit(0).alias("micro"))
    both = hot.unionByName(cold)
    return both.select("region", F.timestamp_micros(F.col("sec") * 1000000 + F.col("micro")).alias("ts"),
                       F.col("v").cast("double").alias("v"))


def test_cells_follow_a_burst(spark):
    df = bursts(spark)
    assert C.cells_needed(df, ["region"], "ts", rows=5000) is None
    length = C.cells_needed(df, ["region"], "ts", rows=100)
    fullest = df.groupBy("region", C.cell_of(C.instant(df, "ts"), length)).count().agg(F.max("count")).first()[0]
    assert fullest <= 400


def test_measured_shapes_equal_the_plain_ones(spark, monkeypatch):
    df = bursts(spark)
    right = df.select("region", F.col("ts").alias("at"), F.col("v").alias("w")).filter("w % 7 = 0")
    import datetime as dt

    def results():
        return [sorted(map(str, x.collect())) for x in (
            asof_join(df, right, "region", "ts", "at"),
            range_stats(df.withColumn("v", F.col("v").cast("bigint")), "v", dt.timedelta(days=2)))]
    want = results()
    monkeypatch.setattr(C, "CELL_ROWS", 100)
    assert results() == want
    lag = [sorted(map(str, lag_delta(df, "v", block_rows=n, offset=3).collect())) for n in (100, 10 ** 6)]
    mean = [sorted(map(str, rolling_mean(df, "v", 5, block_rows=n).collect())) for n in (100, 10 ** 6)]
    assert lag[0] == lag[1] and mean[0] == mean[1]
