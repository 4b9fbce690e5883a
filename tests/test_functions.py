import math

from pyspark.sql import functions as F

from hourcast.functions import (bucket, day_type, default_fill, hour_of_day, iso_weekday,
                                keyed_jitter, relative_change, round_numeric, safe_divide,
                                to_double, trunc_day, utc_day)
from hourcast.functions.expressions import demand_feature_columns
from tests.helpers import ts


def test_iso_weekday_and_day_type(spark):
    # Sat 2024-01-06, Sun 2024-01-07, Mon 2024-01-08
    df = spark.createDataFrame([(ts("2024-01-06 12:00:00"),), (ts("2024-01-07 12:00:00"),),
                                (ts("2024-01-08 12:00:00"),)], "ts timestamp")
    r = df.select(iso_weekday("ts").alias("d"), day_type("ts").alias("t")).collect()
    assert [(x.d, x.t) for x in r] == [(6, "weekend"), (7, "weekend"), (1, "weekday")]


def test_utc_day_edge(spark):
    df = spark.createDataFrame([(ts("2024-01-01 23:00:00"),), (ts("2024-01-02 00:00:00"),)],
                               "ts timestamp")
    r = df.select(utc_day("ts").cast("string"), hour_of_day("ts"),
                  trunc_day("ts").cast("string")).collect()
    assert [tuple(x) for x in r] == [("2024-01-01", 23, "2024-01-01 00:00:00"),
                                     ("2024-01-02", 0, "2024-01-02 00:00:00")]


def test_trunc_day_keeps_input_type(spark):
    from hourcast.operators.rollups import pooled_daily
    for typ in ("timestamp_ntz", "timestamp"):
        df = spark.createDataFrame([(ts("2024-01-01 05:30:00"), 1.0)],
                                   f"observed_at_utc {typ}, temperature_c double")
        out = pooled_daily(df)
        assert out.schema["day_utc"].dataType.simpleString() == typ
        assert str(out.first().day_utc) == "2024-01-01 00:00:00"


def test_bucket_first_match_and_null(spark):
    df = spark.createDataFrame([(-0.1,), (0.0,), (9.99,), (10.0,), (19.9,), (20.0,), (None,)],
                               "t double")
    got = [r[0] for r in df.select(bucket("t")).collect()]
    assert got == ["below_0", "0_to_10", "0_to_10", "10_to_20", "10_to_20", "20_plus",
                   "20_plus"]


def test_default_fill_trims(spark):
    df = spark.createDataFrame([(None,), ("",), ("   ",), (" DE-BY ",), ("\t\n",),
                                ("\tDE-NW\n",)], "r string")
    assert [r[0] for r in df.select(default_fill("r", "DE")).collect()] == \
        ["DE", "DE", "DE", "DE-BY", "DE", "DE-NW"]


def test_safe_divide_zero(spark):
    df = spark.createDataFrame([(0.0, 5.0), (2.0, 3.0)], "a double, b double")
    r = df.select(safe_divide("b", "a").alias("q"), relative_change("a", "b").alias("c")).collect()
    assert r[0].q is None and r[0].c is None
    assert r[1].q == 1.5 and r[1].c == 0.5


def test_round_numeric_half_away(spark):
    df = spark.createDataFrame([(0.5000005,), (-2.5,)], "x double")
    r = df.select(round_numeric("x", 6).cast("double"), round_numeric("x", 0).cast("double")
                  ).collect()
    assert r[0][0] == 0.500001 and r[1][1] == -3.0


def test_to_double_strict_and_lenient(spark):
    import pytest
    df = spark.createDataFrame([("1.5",), ("abc",)], "s string")
    assert [r[0] for r in df.select(to_double("s", lenient=True)).collect()] == [1.5, None]
    with pytest.raises(Exception):
        df.select(to_double("s")).collect()


def test_keyed_jitter_stable_under_repartition(spark):
    df = spark.range(200).select(F.col("id"), (F.col("id") % 7).alias("k"))
    a = {r.id: r.j for r in df.select("id", keyed_jitter("id", "k").alias("j")).collect()}
    b = {r.id: r.j for r in df.repartition(13).select("id", keyed_jitter("id", "k").alias("j"))
         .collect()}
    assert a == b and all(0.0 <= v < 1.0 for v in a.values())


def test_demand_constant_temperature_peaks_at_hour_6(spark):
    rows = [(ts(f"2024-01-08 {h:02d}:00:00"), "R", 18.0) for h in range(24)]
    df = spark.createDataFrame(rows, "ts timestamp, region string, temperature_2m double")
    cols = demand_feature_columns("ts", "temperature_2m")
    out = df.select(hour_of_day("ts").alias("h"), cols["demand_mw"].alias("d")).collect()
    best = max(out, key=lambda r: r.d)
    assert best.h == 6 and math.isclose(best.d, 1300.0)


def test_cluster_conf_sizes_partitions_from_the_largest_shuffle():
    from hourcast.session import cluster_conf
    assert cluster_conf(5 * 1024 ** 4)["spark.sql.shuffle.partitions"] == "20480"
    assert cluster_conf(10 * 1024 ** 2)["spark.sql.shuffle.partitions"] == "2000"   # floor
