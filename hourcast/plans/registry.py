"""Registered queries over the shared test tables, with DuckDB oracle SQL.

Each query takes ``(spark, sf_dir)`` and runs one composite query or report
over the staging pair: hourly energy and weather series that Spark derives from
the whole ``events`` table in one scan (``hourcast.sources.driver_tables``) and
writes once per session to the shared checkpoint folder (:func:`stage_tables`),
just as the analysis reads materialised staging tables.  Doubles that come out
of non-associative aggregation (averages over doubles, trigonometry) are
rounded to 6 places on both sides so engines with different summation order
agree.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.operators import quality as Q
from hourcast.operators.upsert import insert_if_absent, merge_columns, merge_replace
from hourcast.plans import analysis as A
from hourcast.plans import marts as M
from hourcast.plans.features import demand_features
from hourcast.plans.ingest import weather_from_documents
from hourcast.plans.staging import (stage_energy, stage_weather, standard_energy,
                                    standard_weather)
from hourcast.session import checkpoint_dir
from hourcast.sinks import tables as sink
from hourcast.sources import driver_tables as dt
from hourcast.sources.landing import (build_documents, document_violations, flatten,
                                       read_documents)

R6 = 6


def _r(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.round(c, R6).alias(c) if c in cols else F.col(c) for c in df.columns])


_STAGED: dict[tuple, tuple[SparkSession, DataFrame, DataFrame]] = {}


def _signature(spark: SparkSession, sf_dir: str) -> tuple:
    """Identity of the events table: number, sizes, times and names of its files, as one row
    (the files' contents are not read)."""
    files = spark.read.format("binaryFile").load(f"{sf_dir.rstrip('/')}/events.parquet")
    # hashes are added as decimals, in which they cannot overflow
    name = F.xxhash64("path", "modificationTime", "length").cast("decimal(38,0)")
    return tuple(files.agg(F.count(F.lit(1)), F.sum("length"), F.max("modificationTime"), F.sum(name)).first())


def stage_tables(spark: SparkSession, sf_dir: str, mode: str = "regions"):
    """Staging pair (energy, weather) derived from ``events`` and written once.

    The hourly series are aggregated from the whole events table in one pass and
    written as one parquet table under the shared ``spark.checkpoint.dir``; the
    energy and weather staging tables the analytical queries read are
    projections of it (``day`` is stored, so day predicates reach the scan).
    Writing (not caching) cuts the lineage and survives executor loss.  Reused
    for the same session, events table and region mode.
    """
    key = (sf_dir.rstrip("/"), mode, _signature(spark, sf_dir))
    hit = _STAGED.get(key)
    if hit is None or hit[0] is not spark:
        ev = dt.events(spark, sf_dir)
        _, _, agg = dt.hourly_both(ev, mode)      # one scan and one aggregation of events
        path = (f"{checkpoint_dir(spark).rstrip('/')}/hourcast-hourly-{mode}-"
                f"{uuid.uuid4().hex}")
        # One written table holds both measures per (hour, region) cell; the
        # energy and weather staging tables are projections of it on read.
        agg.sortWithinPartitions("region", "ts").write.mode("overwrite").parquet(path)
        energy, weather = dt.split_hourly(spark.read.parquet(path))
        for old in [k for k, v in _STAGED.items() if v[0] is not spark]:
            del _STAGED[old]                      # frames of a stopped session
        _STAGED[key] = (spark, energy, weather)
    return _STAGED[key][1], _STAGED[key][2]


def pair(spark: SparkSession, sf_dir: str, mode: str = "regions"):
    """(energy, weather) staging pair without audit columns."""
    return stage_tables(spark, sf_dir, mode)


def raw_pair(spark: SparkSession, sf_dir: str, mode: str = "regions"):
    """Raw-layer shapes: energy (ts, region, load_mw), weather (time, region, temperature_2m)."""
    e, w = stage_tables(spark, sf_dir, mode)
    return (e.select("ts", "region", "load_mw"),
            w.select(F.col("ts").alias("time"), "region", "temperature_2m"))


def _energy(spark, sf_dir, mode="regions"):
    return pair(spark, sf_dir, mode)[0]


def _weather(spark, sf_dir, mode="regions"):
    return pair(spark, sf_dir, mode)[1]


def _fact(spark, sf_dir, mode="regions"):
    return M.fact_energy_daily(pair(spark, sf_dir, mode)[0], audit=True)


def _dirty(spark, sf_dir):
    return dt.dirty(*pair(spark, sf_dir))


ENERGY_KEYS = ("ts", "region")
CUT_OLD, CUT_NEW, CUT_DIM = "2024-01-20", "2024-01-15", "2024-01-29"
FIRST_LOAD, SECOND_LOAD = "2024-01-31 00:00:00", "2024-02-01 00:00:00"

WEATHER_MART_TESTS = [("not_null", "day_utc", "not_null:day_utc"),
                      ("unique", "day_utc", "unique:day_utc")]
ENERGY_WEATHER_MART_TESTS = [
    ("not_null", "day_utc", "not_null:day_utc"),
    ("not_null", "region", "not_null:region"),
    ("not_null", "avg_load_mw", "not_null:avg_load_mw"),
    ("unique_combination", ["day_utc", "region"], "unique_combination:day_utc,region"),
    ("expression_is_true", "avg_load_mw > 0", "expression_is_true:avg_load_mw > 0"),
]


# ------------------------------------------------------------------ queries
def q_staging_energy(spark, d):
    """Raw energy through the staging step."""
    return stage_energy(raw_pair(spark, d)[0], audit=False)


def q_staging_weather(spark, d):
    """Raw weather through the staging step."""
    return stage_weather(raw_pair(spark, d)[1], audit=False)


def q_cold_shock_events(spark, d):
    return A.cold_shock_events(_weather(spark, d))


def q_next_day_load_increase(spark, d):
    e, w = pair(spark, d)
    return _r(A.next_day_load_increase(e, w), "avg_next_day_increase_rate")


def q_peak_hour_by_region(spark, d):
    return A.peak_hour_by_region(_energy(spark, d))


def q_peak_hour_by_region_numeric(spark, d):
    """Peak hour with the average rounded as ``ROUND(x::numeric, 6)`` (decimal,
    half away from zero), returned as double."""
    from hourcast.functions.numeric import round_numeric
    p = A.peak_hours(_energy(spark, d))
    return p.select("region", "hour_of_day",
                    round_numeric("avg_load_mw", 6).cast("double").alias("avg_load_mw"))


def q_complete_days_energy(spark, d):
    """Energy rows of the last 7 complete days before 2024-01-31."""
    from hourcast.sources.tables import complete_days
    return complete_days(_energy(spark, d), "2024-01-31", 7)


def q_peak_hour_mode(spark, d):
    return A.peak_hour_mode(_energy(spark, d))


def q_weekend_effect(spark, d):
    return A.weekend_effect(_energy(spark, d))


def q_weekday_weekend_by_region(spark, d):
    return _r(A.weekday_weekend_pivot(_energy(spark, d)), "weekday_avg", "weekend_avg")


def q_hourly_join(spark, d):
    return A.hourly_join(*pair(spark, d), limit=48)


def q_rolling_24(spark, d):
    return _r(A.rolling_24(_energy(spark, d), scale=None), "load_roll24h_mw")


def q_rolling_24_chunked(spark, d):
    return _r(A.rolling_24(_energy(spark, d), scale=None, chunk=F.to_date("ts")),
              "load_roll24h_mw")


def q_lag_delta(spark, d):
    return A.lag_delta_load(_energy(spark, d))


def q_lag_delta_chunked(spark, d):
    return A.lag_delta_load(_energy(spark, d), chunk=F.to_date("ts"))


def q_top3_hours(spark, d):
    return A.top_hours(_energy(spark, d), 3)


def q_temp_buckets(spark, d):
    return _r(A.temp_buckets(*pair(spark, d)), "avg_load_mw")


def q_joint_cold_shock(spark, d):
    return A.joint_cold_shock(*pair(spark, d))


def q_dim_date(spark, d):
    e, w = pair(spark, d)
    return M.dim_date(w, e)


def q_dim_region(spark, d):
    e, w = pair(spark, d)
    return M.dim_region(e, w)


def q_fact_daily(spark, d):
    return _r(M.fact_energy_daily(_energy(spark, d), audit=False), "avg_load_mw")


def q_mart_weather_daily(spark, d):
    _, rw = raw_pair(spark, d)
    return _r(M.mart_weather_daily(standard_weather(rw)), "avg_temp_c")


def q_mart_energy_weather_daily(spark, d):
    re_, rw = raw_pair(spark, d)
    return _r(M.mart_energy_weather_daily(standard_energy(re_), standard_weather(rw)),
              "avg_load_mw", "avg_temp_c")


def q_load_spikes(spark, d):
    return Q.spike_report(_energy(spark, d), "load_mw", threshold=400, top=20)


def q_temp_range_report(spark, d):
    return Q.range_report(_weather(spark, d), "temperature_2m", -40, 45, "bad_temp_rows")


def q_load_range_report(spark, d):
    return Q.range_report(_energy(spark, d), "load_mw", 0, 5000, "bad_load_rows")


def q_grain_energy(spark, d):
    return Q.grain_report(_energy(spark, d), ENERGY_KEYS)


def q_grain_weather(spark, d):
    return Q.grain_report(_weather(spark, d), ENERGY_KEYS)


def q_fact_grain(spark, d):
    return Q.grain_report(_fact(spark, d), ["day", "region"], total="fact_rows")


def q_mart_rowcount(spark, d):
    return Q.grain_report(_fact(spark, d), ["day", "region"], total="fact_rows",
                          duplicates=None)


def q_null_report_staging(spark, d):
    return Q.null_report(_energy(spark, d), ["ts", "region", "load_mw", "day"])


def q_null_report_fact(spark, d):
    return Q.null_report(_fact(spark, d), ["day", "region", "avg_load_mw", "min_load_mw",
                                          "max_load_mw", "n_hours", "updated_at"])


def q_rowcount_drift(spark, d):
    return Q.rowcount_drift(_energy(spark, d))


def q_orphan_keys(spark, d):
    e, w = pair(spark, d)
    fact = M.fact_energy_daily(e)
    return Q.missing_dim_report(fact, {"day": M.dim_date(w, e), "region": M.dim_region(e, w)})


def q_orphan_keys_stale_dim(spark, d):
    """Fact refreshed after a date dimension last built before CUT_DIM."""
    e, w = pair(spark, d)
    fact = M.fact_energy_daily(e)
    stale = M.dim_date(w, e).filter(F.col("day") < F.to_date(F.lit(CUT_DIM)))
    return Q.missing_dim_report(fact, {"day": stale, "region": M.dim_region(e, w)})


def q_n_hours_reconciliation(spark, d):
    e = _energy(spark, d)
    return Q.reconcile_counts(M.fact_energy_daily(e), e)


def q_value_order(spark, d):
    return Q.value_order_report(_fact(spark, d))


def q_model_tests_energy_weather(spark, d):
    re_, rw = raw_pair(spark, d)
    mart = M.mart_energy_weather_daily(standard_energy(re_), standard_weather(rw))
    return Q.model_test_failures(mart, ENERGY_WEATHER_MART_TESTS)


def q_model_tests_weather_daily(spark, d):
    _, rw = raw_pair(spark, d)
    return Q.model_test_failures(M.mart_weather_daily(standard_weather(rw)), WEATHER_MART_TESTS)


def _upsert_inputs(spark, d):
    e = _energy(spark, d)
    target = e.filter(F.col("day") < F.to_date(F.lit(CUT_OLD)))
    batch = (e.filter(F.col("day") >= F.to_date(F.lit(CUT_NEW)))
             .withColumn("load_mw", F.col("load_mw") + F.lit(1.0)))
    return target, batch


def q_upsert_energy(spark, d):
    target, batch = _upsert_inputs(spark, d)
    return merge_replace(target, batch, ENERGY_KEYS)


def q_upsert_energy_table(spark, d):
    """The same upsert through the day-partitioned table sink (touched days only)."""
    target, batch = _upsert_inputs(spark, d)
    path = f"{checkpoint_dir(spark).rstrip('/')}/hourcast-upsert-{uuid.uuid4().hex}"
    sink.upsert(spark, target, path, ENERGY_KEYS)           # first load: creates the table
    sink.upsert(spark, batch, path, ENERGY_KEYS)            # upsert of the new batch
    return sink.read(spark, path).select("ts", "region", "load_mw", "day")


def q_upsert_weather_preserve(spark, d):
    w = _weather(spark, d)
    target = (w.filter(F.col("day") < F.to_date(F.lit(CUT_OLD)))
              .select(F.col("ts").alias("time"), "region", "temperature_2m",
                      F.lit(FIRST_LOAD).cast("timestamp_ntz").alias("created_at")))
    batch = (w.filter(F.col("day") >= F.to_date(F.lit(CUT_NEW)))
             .select(F.col("ts").alias("time"), "region",
                     (F.col("temperature_2m") + F.lit(0.5)).alias("temperature_2m")))
    return merge_columns(target, batch, ["time", "region"], update=["temperature_2m"],
                         preserve=["created_at"],
                         defaults={"created_at": F.lit(SECOND_LOAD).cast("timestamp_ntz")})


def q_insert_if_absent(spark, d):
    e, w = pair(spark, d)
    target = w.filter(F.col("day") < F.to_date(F.lit(CUT_OLD))).select("day").distinct()
    batch = e.filter(F.col("day") >= F.to_date(F.lit("2024-01-10"))).select("day")
    return insert_if_absent(target, batch, ["day"])


def q_demand_features(spark, d):
    return demand_features(_weather(spark, d), scale=R6)


def q_landing_roundtrip(spark, d):
    """Weather -> landed JSON files (a document per day and region) -> scan -> checks ->
    flatten -> typed rows."""
    out = weather_from_documents(_landed(spark, d), check=True)
    return out.select(F.col("time").cast("timestamp_ntz").alias("time"), "region",
                      "temperature_2m")


def _landed(spark, d, spoil=None) -> DataFrame:
    """Documents written to the shared folder as JSON lines and read back from it."""
    docs = build_documents(_weather(spark, d)).select("_meta", "regions")
    path = _scratch(spark, "landing")
    (spoil(docs) if spoil else docs).write.json(path)
    return read_documents(spark, path, multi_line=False)


def q_landing_envelope(spark, d):
    """Provenance of every landed row: the six envelope fields next to its counts."""
    flat = flatten(_landed(spark, d), with_meta=True)
    return (flat.groupBy("region", "meta_source", "meta_timezone", "meta_start_date", "meta_end_date")
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_if(F.col("meta_fetched_at_utc").isNotNull()).alias("n_fetched_utc"),
                 F.count_if(F.col("meta_fetched_at_local").isNotNull()).alias("n_fetched_local")))


def _spoiled(docs: DataFrame) -> DataFrame:
    """Documents of four days with one structural fault each."""
    on = lambda day: F.col("_meta.start_date") == day
    entry = lambda **new: F.transform("regions", lambda r: _with(r, **new))
    hourly = lambda time, temps: F.struct(F.struct(
        time.alias("time"), temps.alias("temperature_2m")).alias("hourly"))
    old = F.col("regions")[0]["payload"]["hourly"]
    return docs.withColumn(
        "regions",
        F.when(on("2024-01-03"), F.filter("regions", lambda r: F.lit(False)))
        .when(on("2024-01-04"), entry(region=F.lit(None).cast("string")))
        .when(on("2024-01-05"), entry(payload=hourly(F.lit(None).cast("array<string>"),
                                                     old["temperature_2m"])))
        .when(on("2024-01-06"), entry(payload=hourly(
            F.slice(old["time"], 1, 1), F.concat(old["temperature_2m"], F.array(F.lit(1.0))))))
        .otherwise(F.col("regions")))


def _with(entry, **new):
    return F.struct(*[new.get(c, entry[c]).alias(c) for c in ("region", "latitude", "longitude", "payload")])


def q_landing_violations(spark, d):
    """Structural violations over landed files of which four days are spoiled."""
    found = document_violations(_landed(spark, d, _spoiled))
    kind = F.regexp_replace("problem", r"\d+", "n")
    return found.groupBy(kind.alias("problem")).agg(F.count(F.lit(1)).alias("n_documents"))


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/hourcast-{name}-{uuid.uuid4().hex}"


def q_csv_roundtrip(spark, d):
    """Weather -> processed CSV (text) -> headered scan -> pre-load gate -> typed rows."""
    from hourcast.sources import csv as csv_src
    _, rw = raw_pair(spark, d)
    text = rw.select("region", F.date_format("time", "yyyy-MM-dd'T'HH:mm").alias("time"),
                     F.col("temperature_2m").cast("string").alias("temperature_2m"))
    path = _scratch(spark, "csv")
    sink.write_csv(text, path)
    back = csv_src.read_processed_csv(spark, path, has_region=True)
    Q.gate_ingest(back)
    rows = csv_src.require_rows(csv_src.parse_weather_rows(back))
    return rows.select(F.col("time").cast("timestamp_ntz").alias("time"), "region",
                       "temperature_2m")


def q_daily_run_fact(spark, d):
    """Two overlapping pipeline runs (incremental), then the daily fact table.

    Load is modelled from weather (demand model without jitter), so the result
    is checkable in SQL.
    """
    from hourcast.plans import daily
    _, rw = raw_pair(spark, d)
    wh = _scratch(spark, "warehouse")
    first = rw.filter(F.col("time") < F.lit("2024-01-16").cast("timestamp_ntz"))
    second = rw.filter(F.col("time") >= F.lit("2024-01-14").cast("timestamp_ntz"))
    daily.run(spark, wh, weather=first, jitter=False)
    daily.run(spark, wh, weather=second, jitter=False)
    fact = sink.read(spark, daily.Layout(wh).fact)
    return _r(fact.select("day", "region", "avg_load_mw", "min_load_mw", "max_load_mw",
                          "n_hours"), "avg_load_mw", "min_load_mw", "max_load_mw")


def _fact_of(spark, wh: str) -> DataFrame:
    fact = sink.read(spark, _layout(wh).fact)
    return _r(fact.select("day", "region", "avg_load_mw", "min_load_mw", "max_load_mw",
                          "n_hours"), "avg_load_mw", "min_load_mw", "max_load_mw")


def _layout(wh: str):
    from hourcast.plans import daily
    return daily.Layout(wh)


def _before(df: DataFrame, column: str, when: str) -> DataFrame:
    return df.filter(F.col(column) < F.lit(when).cast("timestamp_ntz"))


# scenarios over every day of the series: one day or region is set apart, and all others
# are loaded too
def _on(df: DataFrame, column: str, day: str) -> tuple[DataFrame, DataFrame]:
    """The rows of one day, and all others."""
    same = F.col(column).cast("date") == F.lit(day).cast("date")
    return df.filter(same), df.filter(~same)


def q_daily_run_measured_whole(spark, d):
    """Measured load of all days with weather of all days but one: every day reaches the fact."""
    from hourcast.plans import daily
    raw_e, raw_w = raw_pair(spark, d)
    wh = _scratch(spark, "measured-whole")
    daily.run(spark, wh, weather=_on(raw_w, "time", "2024-01-02")[1], energy=raw_e)
    return _fact_of(spark, wh)


def q_daily_run_half_day_whole(spark, d):
    """After all other days, one day's load in two halves, the second with a correction of one hour."""
    from hourcast.plans import daily
    raw_e, raw_w = raw_pair(spark, d)
    wh = _scratch(spark, "halves-whole")
    (day_e, other_e), (day_w, other_w) = _on(raw_e, "ts", "2024-01-01"), _on(raw_w, "time", "2024-01-01")
    daily.run(spark, wh, weather=other_w, energy=other_e)
    daily.run(spark, wh, weather=day_w, energy=day_e.filter(F.hour("ts") < 12))
    later = day_e.filter(F.hour("ts") >= 11).withColumn("load_mw", F.col("load_mw") + F.lit(100.0))
    daily.run(spark, wh, weather=day_w, energy=later)
    return _fact_of(spark, wh)


def q_daily_run_repaired_whole(spark, d):
    """One spoiled day stops the batch of all days but one and the run after it; its repair
    takes up every day."""
    from hourcast.plans import daily
    _, raw_w = raw_pair(spark, d)
    wh = _scratch(spark, "repaired-whole")
    second, batch = _on(raw_w, "time", "2024-01-02")
    first, others = _on(batch, "time", "2024-01-01")
    spoiled = others.unionByName(first.withColumn("temperature_2m", F.lit(50.0)))
    failed = 0
    for part in (spoiled, second):
        try:
            daily.run(spark, wh, weather=part, jitter=False)
        except Q.GateFailed:
            failed += 1
    daily.run(spark, wh, weather=first, jitter=False)
    return _fact_of(spark, wh).withColumn("failed_runs", F.lit(failed))


def q_daily_run_dim_region_whole(spark, d):
    """Regions inserted by two runs over all days, the second with one more region."""
    from hourcast.plans import daily
    _, raw_w = raw_pair(spark, d)
    wh = _scratch(spark, "regions-whole")
    daily.run(spark, wh, weather=raw_w.filter(F.col("region") != "DE-BE"), jitter=False)
    daily.run(spark, wh, weather=raw_w, jitter=False)
    return sink.read(spark, _layout(wh).dim_region)


def q_daily_run_mart(spark, d):
    """The written weather mart of two overlapping runs."""
    from hourcast.plans import daily
    _, raw_w = raw_pair(spark, d)
    wh = _scratch(spark, "mart")
    daily.run(spark, wh, weather=_before(raw_w, "time", "2024-01-04"), jitter=False)
    daily.run(spark, wh, weather=raw_w.filter(
        F.col("time") >= F.lit("2024-01-03").cast("timestamp_ntz")), jitter=False)
    return _r(sink.read(spark, _layout(wh).mart_weather_daily), "avg_temp_c")


def q_csv_mixed_whole(spark, d):
    """One folder of CSV files with three layouts, blank regions and incomplete rows."""
    from hourcast.sources import csv as csv_src
    _, rw = raw_pair(spark, d)
    text = rw.select("region", F.date_format("time", "yyyy-MM-dd'T'HH:mm").alias("time"),
                     F.col("temperature_2m").cast("string").alias("temperature_2m"),
                     F.hour("time").alias("h"))
    path = _scratch(spark, "csv-mixed")
    blank = F.when(F.col("region") == "DE-BY", F.lit("  ")).otherwise(F.col("region")).alias("region")
    time = F.when(F.col("h") == 9, F.lit("")).otherwise(F.col("time")).alias("time")
    temp = F.when(F.col("h") == 17, F.lit("")).otherwise(F.col("temperature_2m")).alias("temperature_2m")
    for name, part in (("a", text.filter("h < 8").select(blank, "time", "temperature_2m")),
                       ("b", text.filter("h >= 8 AND h < 16").select("temperature_2m", time, "region")),
                       ("c", text.filter("h >= 16").select("time", temp))):
        sink.write_csv(part, f"{path}/{name}")
    rows = csv_src.parse_weather_rows(csv_src.read_processed_csv(spark, f"{path}/*"))
    return rows.select(F.col("time").cast("timestamp_ntz").alias("time"), "region", "temperature_2m")


# gates as their one-row results, on clean and on dirtied inputs
def q_gate_range(spark, d):
    return Q.range_check(_weather(spark, d), "temperature_2m", -40, 45)


def q_gate_range_dirty(spark, d):
    return Q.range_check(_dirty(spark, d)[1], "temperature_2m", -40, 45)


def q_gate_unique(spark, d):
    return Q.unique_check(_energy(spark, d), ENERGY_KEYS)


def q_gate_unique_dirty(spark, d):
    return Q.unique_check(_dirty(spark, d)[0], ENERGY_KEYS)


def _full_hours(table: DataFrame) -> int:
    """Rows of a table without gaps: its days x 24 x its series."""
    days, series = table.agg(F.count_distinct("day"), F.count_distinct("region")).first()
    return days * 24 * series


def q_gate_rowcount(spark, d):
    energy = _energy(spark, d)
    return Q.rowcount_check(energy, _full_hours(energy))


def q_gate_rowcount_dirty(spark, d):
    dirty = _dirty(spark, d)[0]
    return Q.rowcount_check(dirty, _full_hours(dirty))


def _ingest_text(weather: DataFrame) -> DataFrame:
    return weather.select(F.col("ts").cast("string").alias("time"),
                          F.col("temperature_2m").cast("string").alias("temperature_2m"))


def q_gate_ingest(spark, d):
    return Q.ingest_profile(_ingest_text(_weather(spark, d)))


def q_gate_ingest_dirty(spark, d):
    """No time at hour 1, no value at 2, no number at 4; -100 degC (outside) at hour 3."""
    h = F.hour("time")
    text = _ingest_text(_dirty(spark, d)[1])
    return Q.ingest_profile(text.select(
        F.when(h != 1, F.col("time")).alias("time"),
        F.when(h == 2, F.lit("")).when(h == 4, F.lit("n/a"))
        .otherwise(F.col("temperature_2m")).alias("temperature_2m")))


def q_model_tests_dirty(spark, d):
    """Model tests over a mart with a repeated day, NULL loads and negative loads."""
    e, _ = _dirty(spark, d)
    mart = e.select(F.col("day").alias("day_utc"), "region", "ts",
                    F.when(F.hour("ts") == 5, -F.col("load_mw")).otherwise(F.col("load_mw"))
                    .alias("avg_load_mw"))
    return Q.model_test_failures(mart, [
        ("not_null", "day_utc", "not_null:day_utc"), ("not_null", "avg_load_mw", "not_null:avg_load_mw"),
        ("unique_combination", ["ts", "region"], "unique_combination:ts,region"),
        ("unique", "ts", "unique:ts"),
        ("expression_is_true", "avg_load_mw > 0", "expression_is_true:avg_load_mw > 0")])


def q_n_hours_mismatches(spark, d):
    """Fact rows whose hour count differs from a recount over the dirtied hours."""
    fact = M.fact_energy_daily(_energy(spark, d))
    return Q.reconcile_counts(fact, _dirty(spark, d)[0], mismatches_only=True)


def q_demand_jitter(spark, d):
    """The modelled load's noise: within bounds, and the same after a reshuffle."""
    w = _weather(spark, d)
    model = lambda x: demand_features(x, scale=None, jitter=True)
    plain = demand_features(w, scale=None).select("ts", "region", F.col("demand_mw").alias("base"))
    again = model(w.repartition(7, "temperature_2m")).select("ts", "region", F.col("demand_mw").alias("again"))
    both = model(w).join(again, ["ts", "region"]).join(plain, ["ts", "region"])
    noise = F.abs(F.col("demand_mw") - F.col("base"))
    return both.agg(F.count(F.lit(1)).alias("n_rows"),
                    F.count_if(F.col("demand_mw") != F.col("again")).alias("n_unstable"),
                    F.count_if(noise > 50).alias("n_outside"))


# series with a NULL key and a NULL time, in both window shapes
def q_lag_delta_nulls(spark, d):
    return A.lag_delta_load(dt.with_null_keys(_energy(spark, d)))


def q_lag_delta_nulls_plain(spark, d):
    return A.lag_delta_load(dt.with_null_keys(_energy(spark, d)), chunk=None)


def q_rolling_24_nulls(spark, d):
    return _r(A.rolling_24(dt.with_null_keys(_energy(spark, d)), scale=None), "load_roll24h_mw")


def q_rolling_24_nulls_plain(spark, d):
    return _r(A.rolling_24(dt.with_null_keys(_energy(spark, d)), scale=None, chunk=None),
              "load_roll24h_mw")


# reports in their row order, numbered
def _numbered(name: str):
    def q(spark, d):
        out = globals()[f"q_{name}"](spark, d)
        return A.in_order(name, out, numbered=True)
    q.__name__ = f"q_{name}_ordered"
    q.__doc__ = f"The report {name} in its row order."
    return q


for _name in A.ORDERS:
    globals()[f"q_{_name}_ordered"] = _numbered(_name)


# dirtied inputs: the reports must find what was planted
def q_grain_energy_dirty(spark, d):
    return Q.grain_report(_dirty(spark, d)[0], ENERGY_KEYS)


def q_null_report_staging_dirty(spark, d):
    return Q.null_report(_dirty(spark, d)[0], ["ts", "region", "load_mw", "day"])


def q_temp_range_report_dirty(spark, d):
    return Q.range_report(_dirty(spark, d)[1], "temperature_2m", -40, 45, "bad_temp_rows")


def q_rowcount_drift_dirty(spark, d):
    return Q.rowcount_drift(_dirty(spark, d)[0])


def q_energy_profile_dirty(spark, d):
    """All energy checks fused into one aggregate pass."""
    return Q.table_profile(_dirty(spark, d)[0], ENERGY_KEYS, ["ts", "region", "load_mw", "day"],
                           {"load_mw": (0, 5000)})


def q_weather_profile_dirty(spark, d):
    """All weather checks fused into one aggregate pass (planted -100 degC rows)."""
    return Q.table_profile(_dirty(spark, d)[1], ENERGY_KEYS,
                           ["ts", "region", "temperature_2m", "day"],
                           {"temperature_2m": (-40, 45)})


# scale shape: one series per user
def q_lag_delta_by_user(spark, d):
    return A.lag_delta_load(_energy(spark, d, "users"))


def q_rolling_24_by_user(spark, d):
    return _r(A.rolling_24(_energy(spark, d, "users"), scale=None), "load_roll24h_mw")


def q_top3_hours_by_user(spark, d):
    return A.top_hours(_energy(spark, d, "users"), 3)


def q_mart_energy_weather_daily_by_user(spark, d):
    """Most users have days with load and without weather: the join's NULL side."""
    re_, rw = raw_pair(spark, d, "users")
    return _r(M.mart_energy_weather_daily(standard_energy(re_), standard_weather(rw)),
              "avg_load_mw", "avg_temp_c")


def q_fact_daily_by_user(spark, d):
    return _r(M.fact_energy_daily(_energy(spark, d, "users"), audit=False), "avg_load_mw")


def q_cold_shock_events_by_user(spark, d):
    return A.cold_shock_events(_weather(spark, d, "users"))


def q_peak_hour_mode_by_user(spark, d):
    return A.peak_hour_mode(_energy(spark, d, "users"))


def q_weekend_effect_by_user(spark, d):
    return A.weekend_effect(_energy(spark, d, "users"))


def q_next_day_load_increase_by_user(spark, d):
    e, w = pair(spark, d, "users")
    return _r(A.next_day_load_increase(e, w), "avg_next_day_increase_rate")


def q_joint_cold_shock_by_user(spark, d):
    return A.joint_cold_shock(*pair(spark, d, "users"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}
