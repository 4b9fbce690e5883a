import random

from pyspark.sql import functions as F

from hourcast.operators.windows import lag_delta, rolling_mean
from hourcast.plans import analysis as A
from tests.helpers import collect_sorted, energy_df, weather_df


def test_lag_is_previous_row_not_previous_hour(spark):
    e = energy_df(spark, [("2024-01-01 00:00:00", "R", 10.0), ("2024-01-01 01:00:00", "R", 12.0),
                          ("2024-01-01 05:00:00", "R", 20.0)])  # gap 02..04
    r = collect_sorted(A.lag_delta_load(e), "ts")
    assert [(x[3], x[4]) for x in r] == [(None, None), (10.0, 2.0), (12.0, 8.0)]


def test_rolling_partial_frame_at_start(spark):
    rows = [(f"2024-01-01 {h:02d}:00:00", "R", float(h)) for h in range(24)] + \
           [("2024-01-02 00:00:00", "R", 24.0)]
    r = collect_sorted(A.rolling_24(energy_df(spark, rows), scale=None), "ts")
    assert r[0][3] == 0.0 and r[1][3] == 0.5
    assert r[23][3] == sum(range(24)) / 24 and r[24][3] == sum(range(1, 25)) / 24


def test_top_hours_dense_rank_keeps_ties(spark):
    rows = [("2024-01-01 01:00:00", "R", 5.0), ("2024-01-01 02:00:00", "R", 5.0),
            ("2024-01-01 03:00:00", "R", 4.0), ("2024-01-01 04:00:00", "R", 3.0),
            ("2024-01-01 05:00:00", "R", 2.0)]
    r = collect_sorted(A.top_hours(energy_df(spark, rows), 3), "ts")
    assert [x[-1] for x in r] == [1, 1, 2, 3]


def test_peak_hour_tie_break_is_earlier_hour(spark):
    rows = [("2024-01-01 03:00:00", "R", 9.0), ("2024-01-01 07:00:00", "R", 9.0)]
    r = A.peak_hour_by_region(energy_df(spark, rows)).collect()
    assert r[0].hour_of_day == 3


def test_weekend_effect_zero_weekday_average_is_null_rate(spark):
    rows = [("2024-01-08 01:00:00", "R", 0.0), ("2024-01-06 01:00:00", "R", 5.0)]
    r = A.weekend_effect(energy_df(spark, rows)).collect()[0]
    assert r.avg_diff_mw == 5.0 and r.avg_diff_rate is None


def test_weekend_effect_series_without_weekend_is_skipped(spark):
    rows = [("2024-01-08 01:00:00", "A", 10.0), ("2024-01-06 01:00:00", "A", 12.0),
            ("2024-01-08 01:00:00", "B", 100.0)]
    r = A.weekend_effect(energy_df(spark, rows)).collect()[0]
    assert r.avg_diff_mw == 2.0 and r.avg_diff_rate == 0.2


def test_cold_shock_first_row_null_dropped(spark):
    w = weather_df(spark, [("2024-01-01 00:00:00", "R", 10.0), ("2024-01-01 01:00:00", "R", 4.0),
                           ("2024-01-01 02:00:00", "R", 3.0)])
    r = A.cold_shock_events(w).collect()
    assert len(r) == 1 and r[0].temp_drop == -6.0


def test_next_day_needs_load_on_both_days(spark):
    w = weather_df(spark, [("2024-01-01 00:00:00", "R", 10.0), ("2024-01-01 01:00:00", "R", 0.0),
                           ("2024-01-02 00:00:00", "R", 10.0), ("2024-01-02 01:00:00", "R", 1.0)])
    e = energy_df(spark, [("2024-01-01 00:00:00", "R", 100.0), ("2024-01-02 00:00:00", "R", 110.0)])
    r = A.next_day_load_increase(e, w).collect()[0]
    # shock on 01-01 (-10) and 01-02 (-9 vs previous row); only 01-01 has a next day
    assert r.n_events == 1 and abs(r.avg_next_day_increase_rate - 0.1) < 1e-12


def _random_series(spark, n_keys=4, n_hours=300, seed=7):
    rnd = random.Random(seed)
    rows = []
    for k in range(n_keys):
        h = 0
        for _ in range(n_hours):
            h += rnd.choice([1, 1, 1, 2, 5, 30])   # gaps, including whole missing days
            rows.append((f"2024-01-01 00:00:00", f"K{k}", float(rnd.randint(0, 1000)), h))
    df = spark.createDataFrame(rows, "t string, region string, load_mw double, h int")
    secs = F.unix_timestamp(F.to_timestamp("t")) + F.col("h") * F.lit(3600)
    return df.select(F.timestamp_seconds(secs).alias("ts"), "region", "load_mw")


def test_default_windows_equal_plain(spark):
    df = _random_series(spark)
    # NULL keys and one NULL time per series are rows like any other
    lost = F.col("region").isin("K0", "K1") & (F.col("ts") == F.lit("2024-01-01 01:00:00").cast("timestamp"))
    df = df.select(F.when(~lost, F.col("ts")).alias("ts"),
                   F.when(F.col("region") != "K2", F.col("region")).alias("region"), "load_mw")
    for chunk in ("calendar", F.to_date("ts")):
        for block_rows in (24, 57, 1000):
            plain = lag_delta(df, "load_mw", keys=["region"], chunk=None).collect()
            blocks = lag_delta(df, "load_mw", keys=["region"], chunk=chunk,
                               block_rows=block_rows).collect()
            assert sorted(map(str, plain)) == sorted(map(str, blocks)) and len(plain) == 1200
    rounded = lambda f: f.withColumn("load_mw_roll24", F.round("load_mw_roll24", 6))
    p = rounded(rolling_mean(df, "load_mw", 24, keys=["region"], chunk=None)).collect()
    c = rounded(rolling_mean(df, "load_mw", 24, keys=["region"], block_rows=57)).collect()
    assert sorted(map(str, p)) == sorted(map(str, c))


def test_chunked_joint_cold_shock_equal_plain(spark):
    df = _random_series(spark, n_keys=2, n_hours=200, seed=3)
    e = df.withColumn("day", F.to_date("ts"))
    w = df.select("ts", "region", (F.pmod(F.col("load_mw") * 7, F.lit(1000.0)) / 40 - 5).alias("temperature_2m"),
                  F.to_date("ts").alias("day"))
    plain = collect_sorted(A.joint_cold_shock(e, w, load_rise=1.0, chunk=None))
    chunked = collect_sorted(A.joint_cold_shock(e, w, load_rise=1.0))
    assert plain == chunked and len(plain) > 0


def test_demand_model_constant_temperature_peak_hour_6_every_region(spark):
    from hourcast.plans.features import energy_from_weather
    rows = [(f"2024-01-{d:02d} {h:02d}:00:00", r, 18.0)
            for d in range(1, 15) for h in range(24) for r in ("DE-NW", "DE-BY", "DE-BE")]
    w = spark.createDataFrame(rows, "t string, region string, temperature_2m double") \
        .select(F.to_timestamp("t").alias("time"), "region", "temperature_2m")
    e = energy_from_weather(w, time_col="time", jitter=True).withColumn("day", F.to_date("ts"))
    got = {r.region: r.hour_of_day for r in A.peak_hour_by_region(e).collect()}
    assert got == {"DE-NW": 6, "DE-BY": 6, "DE-BE": 6}


def test_row_index_exact_for_hot_key(spark):
    from hourcast.operators.windows import row_indexed
    # one hot series with most rows, spread over many day chunks, plus small ones
    hot = [(f"2024-01-01 00:00:00", "HOT", float(i), i) for i in range(0, 3000, 1)]
    cold = [(f"2024-01-01 00:00:00", f"C{k}", 1.0, i) for k in range(3) for i in range(0, 50, 7)]
    df = spark.createDataFrame(hot + cold, "t string, region string, load_mw double, h int")
    secs = F.unix_timestamp(F.to_timestamp("t")) + F.col("h") * F.lit(3600)
    df = df.select(F.timestamp_seconds(secs).alias("ts"), "region", "load_mw")
    idx = row_indexed(df, ["region"], "ts", F.to_date("ts"))
    rows = idx.select("region", "ts", "__hc_idx").collect()
    by_key = {}
    for r in rows:
        by_key.setdefault(r.region, []).append((r.ts, r["__hc_idx"]))
    for k, v in by_key.items():
        v.sort()
        assert [i for _, i in v] == list(range(len(v))), k
    assert len(by_key["HOT"]) == 3000


def test_a_series_dense_within_one_hour(spark):
    # every row of the hot series lies in one hour: blocks still split it
    hot = spark.range(5000).select(
        F.timestamp_micros(F.lit(1704067200000000) + F.col("id") * 1000).alias("ts"),
        F.lit("HOT").alias("region"), (F.col("id") * 1.0).alias("load_mw"))
    got = lag_delta(hot, "load_mw", keys=["region"], block_rows=100)
    assert got.filter("load_mw_delta = 1.0").count() == 4999


def test_reports_come_in_their_order(spark):
    rows = [(f"2024-01-0{d} 0{h}:00:00", r, float(h)) for d in (1, 2) for h in (1, 2) for r in "BA"]
    top = A.in_order("top3_hours", A.top_hours(energy_df(spark, rows), 1)).collect()
    assert [(str(x.day), x.region) for x in top] == [
        ("2024-01-02", "A"), ("2024-01-02", "B"), ("2024-01-01", "A"), ("2024-01-01", "B")]


def test_desc_rank_puts_nulls_first_like_postgres(spark):
    e = energy_df(spark, [("2024-01-01 01:00:00", "R", 5.0), ("2024-01-01 02:00:00", "R", None),
                          ("2024-01-01 03:00:00", "R", 7.0)])
    r = collect_sorted(A.top_hours(e, 1), "ts")
    assert [(x[3], x[4]) for x in r] == [(None, 1)]
