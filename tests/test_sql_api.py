"""The registered tables answer SQL the way the DataFrame operators do."""

import os

import pytest
from pyspark.sql import functions as F

from hourcast.plans import analysis as A
from hourcast.plans import daily
from hourcast.plans.registry import raw_pair
from hourcast.sinks import tables as sink
from tests.conftest import SF
from tests.helpers import collect_sorted


@pytest.fixture(scope="module")
def layout(spark):
    import tempfile
    wh = os.path.join(tempfile.mkdtemp(prefix="hourcast-sql-"), "wh")
    _, raw_w = raw_pair(spark, SF)
    daily.run(spark, wh, weather=raw_w, jitter=False, register_tables=True)
    return daily.Layout(wh)


def test_sql_over_the_tables_equals_the_dataframe_answers(spark, layout):
    e = sink.read(spark, layout.staging_energy)
    low_high = spark.sql("""SELECT region, min_by(ts, load_mw) AS low, max_by(ts, load_mw) AS high
                            FROM staging.energy_hourly_clean GROUP BY region""")
    assert collect_sorted(low_high) == collect_sorted(e.groupBy("region").agg(
        F.min_by("ts", "load_mw").alias("low"), F.max_by("ts", "load_mw").alias("high")))
    wd, we = (F.avg(F.when(F.weekday("ts") < 5 if d else F.weekday("ts") >= 5, F.col("load_mw"))) for d in (1, 0))
    per = e.groupBy("region").agg(wd.alias("wd"), we.alias("we")).collect()
    got = A.weekend_effect(e).first()
    assert got.avg_diff_mw == pytest.approx(sum(r.we - r.wd for r in per) / len(per), abs=1e-5)
    assert got.avg_diff_rate == pytest.approx(sum(r.we / r.wd - 1 for r in per) / len(per), abs=1e-5)


def test_lag_against_the_collected_rows(spark, layout):
    rows = spark.sql("FROM staging.energy_hourly_clean SELECT region, ts, load_mw").collect()
    series = {}
    for r in sorted(rows):
        series.setdefault(r.region, []).append(r)
    want = {(r.region, r.ts): (before.load_mw if before else None)
            for s in series.values() for before, r in zip([None, *s], s)}
    got = {(r.region, r.ts): r.load_prev_mw for r in A.lag_delta_load(sink.read(spark, layout.staging_energy)).collect()}
    assert got == want


def test_keys_of_the_registered_tables(spark, layout):
    fact = spark.table("mart.fact_energy_load_daily")
    assert fact.count() == fact.select("day", "region").distinct().count() > 0
    for key, dim in (("day", "mart.dim_date"), ("region", "mart.dim_region")):
        assert fact.join(spark.table(dim), key, "left_anti").isEmpty()
    assert spark.table("stg_energy_hourly").filter("load_mw > 0").count() == \
        sink.read(spark, layout.raw_energy).count()
