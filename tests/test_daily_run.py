import os

from pyspark.sql import functions as F

from hourcast.plans import daily
from hourcast.plans.registry import raw_pair
from hourcast.sinks import tables as sink
from tests.conftest import SF
from tests.helpers import collect_sorted


def _rows(spark, path, *cols):
    return sorted(tuple(r) for r in sink.read(spark, path).select(*cols).collect())


def test_daily_run_incremental_equals_full(spark, tmp_dir):
    raw_e, raw_w = raw_pair(spark, SF)
    early = raw_w.filter(F.col("time") < F.lit("2024-01-16").cast("timestamp_ntz"))
    late = raw_w.filter(F.col("time") >= F.lit("2024-01-14").cast("timestamp_ntz")) \
        .withColumn("temperature_2m", F.col("temperature_2m") + F.lit(0.25))
    inc, full = os.path.join(tmp_dir, "inc"), os.path.join(tmp_dir, "full")
    daily.run(spark, inc, weather=early)
    res = daily.run(spark, inc, weather=late)
    daily.run(spark, full, weather=early, incremental=False)
    daily.run(spark, full, weather=late, incremental=False)
    lay_i, lay_f = daily.Layout(inc), daily.Layout(full)
    for name, cols in [("staging_weather", ("ts", "region", "temperature_2m", "day")),
                       ("staging_energy", ("ts", "region", "load_mw", "day")),
                       ("fact", ("day", "region", "avg_load_mw", "n_hours")),
                       ("mart_energy_weather_daily", ("day_utc", "region", "avg_load_mw",
                                                      "avg_temp_c")),
                       ("mart_weather_daily", ("day_utc", "avg_temp_c", "min_temp_c",
                                               "max_temp_c", "hourly_obs_count")),
                       ("dim_date", ("day",)), ("dim_region", ("region",))]:
        assert _rows(spark, getattr(lay_i, name), *cols) == \
            _rows(spark, getattr(lay_f, name), *cols), name
    # the second batch updated overlapping days and kept first-insert created_at
    w = sink.read(spark, lay_i.raw_weather)
    assert w.count() == raw_w.count()
    n_weather = raw_w.count()
    assert sink.read(spark, lay_i.staging_energy).count() == n_weather
    rep = {k: v.collect() for k, v in res.reports.items()}
    assert rep["missing_dim_keys"][0][0] == 0
    assert rep["fact_grain"][0].duplicate_rows == 0
    assert rep["value_order"][0].bad_rows == 0


def test_stream_landing_available_now(spark, tmp_dir):
    from hourcast.sources.landing import build_documents
    from hourcast.streaming.landing_stream import start
    _, raw_w = raw_pair(spark, SF)
    w = raw_w.select(F.col("time").alias("ts"), "region", "temperature_2m")
    landing_dir = os.path.join(tmp_dir, "landing")
    docs = build_documents(w).select("_meta", "regions")
    docs.filter(F.col("_meta.start_date") < "2024-01-10").write.json(landing_dir + "/a")
    wh, ck = os.path.join(tmp_dir, "wh"), os.path.join(tmp_dir, "ck")
    q = start(spark, landing_dir + "/*", wh, ck, multi_line=False)
    q.awaitTermination(300)
    lay = daily.Layout(wh)
    n1 = sink.read(spark, lay.staging_weather).count()
    docs.filter(F.col("_meta.start_date") >= "2024-01-10").write.json(landing_dir + "/b")
    q = start(spark, landing_dir + "/*", wh, ck, multi_line=False)
    q.awaitTermination(300)
    n2 = sink.read(spark, lay.staging_weather).count()
    assert 0 < n1 < n2 == raw_w.count()


def test_catalog_registration_and_sql(spark, tmp_dir):
    _, raw_w = raw_pair(spark, SF)
    wh = os.path.join(tmp_dir, "cat")
    first = raw_w.filter(F.col("time") < F.lit("2024-01-10").cast("timestamp_ntz"))
    daily.run(spark, wh, weather=first, register_tables=True)
    n1 = spark.sql("SELECT COUNT(*) FROM staging.energy_hourly_clean").first()[0]
    daily.run(spark, wh, weather=raw_w, register_tables=True)   # new days become visible
    r = spark.sql("""
        SELECT COUNT(*) AS total_rows, COUNT(DISTINCT (ts, region)) AS distinct_grain
        FROM staging.energy_hourly_clean""").first()
    assert n1 < r.total_rows == r.distinct_grain == raw_w.count()
    v = spark.sql("SELECT COUNT(*) FROM stg_weather_hourly WHERE temperature_c IS NOT NULL").first()
    assert v[0] == raw_w.count()
    f = spark.sql("SELECT SUM(n_hours) FROM mart.fact_energy_load_daily").first()[0]
    assert f == r.total_rows


def test_daily_run_complete_days_window(spark, tmp_dir):
    _, raw_w = raw_pair(spark, SF)
    wh = os.path.join(tmp_dir, "asof")
    daily.run(spark, wh, weather=raw_w, as_of="2024-01-11", n_days=5)
    days = sorted(str(r.day) for r in sink.read(spark, daily.Layout(wh).staging_weather)
                  .select("day").distinct().collect())
    assert days == ["2024-01-06", "2024-01-07", "2024-01-08", "2024-01-09", "2024-01-10"]


def test_gate_failure_stops_before_marts(spark, tmp_dir):
    from hourcast.operators.quality import GateFailed
    _, raw_w = raw_pair(spark, SF)
    hot = raw_w.withColumn("temperature_2m",        # inside the ingest bounds [-50, 60],
                           F.when(F.hour("time") == 12, F.lit(50.0))   # outside [-40, 45]
                           .otherwise(F.col("temperature_2m")))
    wh = os.path.join(tmp_dir, "gated")
    import pytest
    with pytest.raises(GateFailed, match="temperature_2m within"):
        daily.run(spark, wh, weather=hot)
    lay = daily.Layout(wh)
    assert sink.path_exists(spark, lay.staging_weather)        # staging was loaded
    for t in ("fact", "dim_date", "mart_weather_daily", "mart_energy_weather_daily"):
        assert not sink.path_exists(spark, getattr(lay, t)), t


def test_duplicate_batch_keys_fail_before_any_write(spark, tmp_dir):
    from hourcast.operators.upsert import DuplicateKeyError
    _, raw_w = raw_pair(spark, SF)
    dup = raw_w.unionByName(raw_w.limit(1))
    wh = os.path.join(tmp_dir, "dups")
    import pytest
    with pytest.raises(DuplicateKeyError):
        daily.run(spark, wh, weather=dup)
    assert not sink.path_exists(spark, daily.Layout(wh).raw_weather)


def test_command_line_run(spark, tmp_dir, capsys):
    from hourcast.__main__ import main
    from hourcast.sources.landing import build_documents
    _, raw_w = raw_pair(spark, SF)
    landing_dir = os.path.join(tmp_dir, "landing")
    build_documents(raw_w.withColumnRenamed("time", "ts"), doc_buckets=1) \
        .select("_meta", "regions").write.json(landing_dir)
    wh = os.path.join(tmp_dir, "cli")
    assert main(["--warehouse", wh, "--landing", landing_dir, "--json-lines"]) == 0
    import json
    out = [json.loads(line) for line in capsys.readouterr().out.splitlines()
           if line.startswith("{")]
    reports = {o["report"]: o for o in out}
    assert reports["missing_dim_keys"]["missing_dim_keys"] == 0
    assert reports["weather_profile"]["total_rows"] == raw_w.count()


def test_run_keeps_a_callers_cache(spark, tmp_dir):
    _, raw_w = raw_pair(spark, SF)
    mine = raw_w.filter(F.col("time") < F.lit("2024-01-03").cast("timestamp_ntz")).cache()
    mine.count()
    daily.run(spark, os.path.join(tmp_dir, "cache"), weather=mine)
    assert mine.is_cached
    mine.unpersist()


def test_stream_takes_a_correction_in_the_same_batch(spark, tmp_dir):
    import json

    from hourcast.streaming.landing_stream import start
    landing_dir = os.path.join(tmp_dir, "corrections")
    os.makedirs(landing_dir)
    for name, fetched, temp in (("a", "2024-01-02T00:00:00+00:00", 1.0), ("b", "2024-01-03T00:00:00+00:00", 2.0)):
        doc = {"_meta": {"source": "s", "fetched_at_utc": fetched}, "regions": [
            {"region": "R", "payload": {"hourly": {"time": ["2024-01-01T00:00"], "temperature_2m": [temp]}}}]}
        with open(os.path.join(landing_dir, f"{name}.json"), "w") as f:
            json.dump(doc, f)
    wh = os.path.join(tmp_dir, "wh_corr")
    start(spark, landing_dir, wh, os.path.join(tmp_dir, "ck_corr")).awaitTermination(300)
    assert [r.temperature_2m for r in sink.read(spark, daily.Layout(wh).staging_weather).collect()] == [2.0]


def test_stream_fails_on_a_malformed_document_before_writing(spark, tmp_dir):
    import json

    import pytest

    from hourcast.streaming.landing_stream import start
    landing_dir = os.path.join(tmp_dir, "bad_landing")
    os.makedirs(landing_dir)
    doc = {"_meta": {"source": "s"}, "regions": [
        {"region": "R", "payload": {"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"],
                                               "temperature_2m": [1.0]}}}]}
    with open(os.path.join(landing_dir, "d.json"), "w") as f:
        json.dump(doc, f, indent=2)
    wh, ck = os.path.join(tmp_dir, "wh_bad"), os.path.join(tmp_dir, "ck_bad")
    q = start(spark, landing_dir, wh, ck)
    with pytest.raises(Exception, match="2 times for 1 temperatures"):
        q.awaitTermination(300)
    assert not sink.path_exists(spark, daily.Layout(wh).raw_weather)


def test_run_from_processed_csv(spark, tmp_dir):
    _, raw_w = raw_pair(spark, SF)
    text = raw_w.select("region", F.date_format("time", "yyyy-MM-dd'T'HH:mm").alias("time"),
                        F.col("temperature_2m").cast("string").alias("temperature_2m"))
    csv_dir = os.path.join(tmp_dir, "processed_csv")
    sink.write_csv(text, csv_dir)
    wh = os.path.join(tmp_dir, "from_csv")
    daily.run(spark, wh, csv=csv_dir)
    got = sink.read(spark, daily.Layout(wh).staging_weather)
    assert got.count() == raw_w.count()


def test_measured_energy_is_used_and_checked(spark, tmp_dir):
    import pytest

    from hourcast.operators.upsert import DuplicateKeyError
    raw_e, raw_w = raw_pair(spark, SF)
    wh = os.path.join(tmp_dir, "measured")
    daily.run(spark, wh, weather=raw_w, energy=raw_e)
    got = collect_sorted(sink.read(spark, daily.Layout(wh).staging_energy)
                         .select("ts", "region", "load_mw"))
    assert got == collect_sorted(raw_e)     # the batch covers every day of the measured load
    with pytest.raises(DuplicateKeyError):
        daily.run(spark, os.path.join(tmp_dir, "measured_dup"), weather=raw_w,
                  energy=raw_e.unionByName(raw_e.limit(1)))


def _days(df, col, first, last):
    at = F.col(col)
    return df.filter((at >= F.lit(first).cast("timestamp_ntz")) & (at < F.lit(last).cast("timestamp_ntz")))


def test_a_failed_day_blocks_later_runs_until_repaired(spark, tmp_dir):
    import pytest

    from hourcast.operators.quality import GateFailed
    _, raw_w = raw_pair(spark, SF)
    one, two = _days(raw_w, "time", "2024-01-01", "2024-01-02"), _days(raw_w, "time", "2024-01-02", "2024-01-03")
    bad = one.withColumn("temperature_2m", F.lit(50.0))
    wh = os.path.join(tmp_dir, "pending")
    lay = daily.Layout(wh)
    for batch in (bad, two):
        with pytest.raises(GateFailed, match="temperature_2m within"):
            daily.run(spark, wh, weather=batch)
    assert daily.pending_days(spark, lay) == ["2024-01-01", "2024-01-02"]
    daily.run(spark, wh, weather=one)
    assert daily.pending_days(spark, lay) == []
    days = sorted(str(r.day) for r in sink.read(spark, lay.fact).select("day").distinct().collect())
    assert days == ["2024-01-01", "2024-01-02"]
    assert sorted(str(r.day) for r in sink.read(spark, lay.dim_date).collect()) == days


def test_measured_load_outside_the_weather_days_is_kept(spark, tmp_dir):
    raw_e, raw_w = raw_pair(spark, SF)
    w, e = _days(raw_w, "time", "2024-01-01", "2024-01-02"), _days(raw_e, "ts", "2024-01-01", "2024-01-03")
    got = []
    for name, incremental in (("inc", True), ("full", False)):
        wh = os.path.join(tmp_dir, f"two_days_{name}")
        daily.run(spark, wh, weather=w, energy=e, incremental=incremental)
        got.append(_rows(spark, daily.Layout(wh).fact, "day", "region", "avg_load_mw", "n_hours"))
    assert got[0] == got[1] and len({r[0] for r in got[0]}) == 2


def test_measured_half_days_add_up_and_the_marts_agree(spark, tmp_dir):
    raw_e, raw_w = raw_pair(spark, SF)
    w, e = _days(raw_w, "time", "2024-01-01", "2024-01-02"), _days(raw_e, "ts", "2024-01-01", "2024-01-02")
    wh = os.path.join(tmp_dir, "halves")
    lay = daily.Layout(wh)
    daily.run(spark, wh, weather=w, energy=e.filter(F.hour("ts") < 12))
    daily.run(spark, wh, weather=w, energy=e.filter(F.hour("ts") >= 12).withColumn("load_mw", F.lit(300.0)))
    assert sink.read(spark, lay.raw_energy).count() == sink.read(spark, lay.staging_energy).count() == e.count()
    assert _rows(spark, lay.fact, "day", "region", "avg_load_mw") == \
        _rows(spark, lay.mart_energy_weather_daily, "day_utc", "region", "avg_load_mw")


def test_a_failed_dimension_write_leaves_no_fact(spark, tmp_dir, monkeypatch):
    import pytest
    _, raw_w = raw_pair(spark, SF)
    wh = os.path.join(tmp_dir, "no_dim")
    lay = daily.Layout(wh)
    real = sink.insert_new

    def fails(spark_, batch, path, *a, **k):
        if path == lay.dim_region:
            raise OSError("disk full")
        return real(spark_, batch, path, *a, **k)

    monkeypatch.setattr(daily.sink, "insert_new", fails)
    with pytest.raises(OSError):
        daily.run(spark, wh, weather=_days(raw_w, "time", "2024-01-01", "2024-01-02"))
    assert not sink.table_exists(spark, lay.fact)


def test_the_foreign_key_gate_stops_orphans(spark, tmp_dir):
    import pytest

    from hourcast.operators import quality as Q
    fact = spark.createDataFrame([("a",), ("b",)], "region string")
    Q.gate_references(fact, {"region": fact})
    with pytest.raises(Q.GateFailed, match="1 rows without"):
        Q.gate_references(fact, {"region": fact.filter("region = 'a'")})
