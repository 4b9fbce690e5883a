"""Registered queries over drifting documents, stored sketches and bucketed tables, each
beside its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.operators import sketches as S
from hourcast.plans import oracle as O
from hourcast.plans import registry as R
from hourcast.sinks.bucketed import buckets_for, write_bucketed
from hourcast.sources import driver_tables as D
from hourcast.sources.drifting import drifting_hours, drifting_report, read_lines
from hourcast.sources.landing import build_documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _register(sql: str, name: str | None = None, mode: str = "regions"):
    def add(fn):
        QUERIES[name or fn.__name__] = fn
        ORACLE_SQL[name or fn.__name__] = O._q(sql, mode)
        return fn
    return add


# --- documents of drifting shape ----------------------------------------------------------

def _drifted(spark, d) -> DataFrame:
    """All days as documents; one day has more fields, one fewer, one numbers as text, one
    is cut off, one has no region names, and one has an hour too many."""
    docs = build_documents(R._weather(spark, d)).select("_meta", "regions")
    on = lambda day: F.col("_meta.start_date") == day
    whole = F.to_json(F.struct("_meta", "regions"))

    def regions(**new):
        return F.to_json(F.struct("_meta", F.transform("regions", lambda r: F.struct(
            *[(new[c](r) if c in new else r[c]).alias(c) for c in ("region", "payload")])).alias("regions")))
    hourly = lambda time, temps: F.struct(F.struct(time.alias("time"), temps.alias("temperature_2m"))
                                          .alias("hourly"))
    text = (F.when(on("2024-01-03"), F.concat(F.lit('{"version": [2, null], "more": {"a": 1}, '), F.substring(whole, 2, 1 << 30)))
            .when(on("2024-01-04"), F.to_json(F.struct("regions")))
            .when(on("2024-01-05"), regions(payload=lambda r: hourly(
                r.payload.hourly.time, r.payload.hourly.temperature_2m.cast("array<string>"))))
            .when(on("2024-01-06"), F.substring(whole, 1, 40))
            .when(on("2024-01-07"), regions(region=lambda r: F.lit(None).cast("string")))
            .when(on("2024-01-08"), regions(payload=lambda r: hourly(
                F.concat(r.payload.hourly.time, F.array(F.lit("2024-01-08T23:30"))), r.payload.hourly.temperature_2m)))
            .otherwise(whole))
    path = R._scratch(spark, "drifting")
    docs.select(text.alias("value")).write.text(path)
    return read_lines(spark, path)


@_register("SELECT ts AS time, region, temperature_2m FROM weather "
           "WHERE day NOT IN (DATE '2024-01-06', DATE '2024-01-07')")
def landing_drift(spark, d):
    """The hours of documents whose shape drifts, all that can be read."""
    return drifting_hours(_drifted(spark, d)).select(
        F.col("time").cast("timestamp_ntz").alias("time"), "region", "temperature_2m")


@_register("""
SELECT CASE day WHEN DATE '2024-01-06' THEN 'broken JSON' WHEN DATE '2024-01-07' THEN 'region without name'
                WHEN DATE '2024-01-08' THEN 'arrays of unequal length' ELSE 'fine' END AS status,
       COUNT(DISTINCT (day, region)) AS n
FROM weather GROUP BY 1""")
def landing_drift_report(spark, d):
    """What was wrong with these documents, counted."""
    return drifting_report(_drifted(spark, d))


# --- sketches ---------------------------------------------------------------------------------

@_register("""
SELECT CASE user_id % 3 WHEN 0 THEN 'DE-NW' WHEN 1 THEN 'DE-BY' ELSE 'DE-BE' END AS region, COUNT(*) AS n_rows,
       TRUE AS median_ok, TRUE AS p95_ok, TRUE AS users_ok
FROM events GROUP BY 1""")
def event_sketches(spark, d):
    """Daily sketches of event values and users, stored, merged over all days and held against
    the exact figures: ranks within 3 % of the rows, distinct users within 6 %."""
    ev = D.events(spark, d).select(D.region_of(F.col("user_id")).alias("region"), F.to_date("ts").alias("day"),
                                   "user_id", "value")
    path = R._scratch(spark, "sketches")
    S.sketched(ev, ["day", "region"], "value", "user_id").write.partitionBy("day").parquet(path)
    whole = S.merged(spark.read.parquet(path), ["region"]).select(
        "region", "n_rows", S.quantile(0.5).alias("median"), S.quantile(0.95).alias("p95"),
        S.distinct_estimate().alias("users"))
    exact = ev.join(whole, "region").groupBy("region", "n_rows").agg(
        F.count("value").alias("n"), F.count_if(F.col("value") <= F.col("median")).alias("to_median"),
        F.count_if(F.col("value") <= F.col("p95")).alias("to_p95"),
        F.count_distinct("user_id").alias("n_users"), F.first("users").alias("users"))
    near = lambda c, share: F.abs(F.col(c) / F.col("n") - share) <= 0.03
    return exact.select("region", "n_rows", near("to_median", 0.5).alias("median_ok"), near("to_p95", 0.95).alias("p95_ok"),
                        (F.abs(F.col("users") / F.col("n_users") - 1) <= 0.06).alias("users_ok"))


# --- bucketed tables ----------------------------------------------------------------------------

def bucketed_pair(spark, d, keys, mode: str = "regions") -> tuple[DataFrame, DataFrame]:
    """Energy and weather as tables bucketed by ``keys``."""
    out = []
    for side, rows in zip(("energy", "weather"), R.pair(spark, d, mode)):
        path = R._scratch(spark, f"bucketed-{side}")
        out.append(write_bucketed(rows, f"bucketed_{side}_{path.rpartition('-')[2]}", path, keys,
                                  buckets_for(rows.count()), sort=["ts"]))
    return out[0], out[1]


_BUCKETED_JOIN = """
SELECT e.ts, e.region, e.load_mw, w.temperature_2m FROM energy e JOIN weather w USING (ts, region)"""


def _bucketed_join(spark, d, mode):
    energy, weather = bucketed_pair(spark, d, ["region", "ts"], mode)
    return energy.join(weather.drop("day"), ["region", "ts"]).select("ts", "region", "load_mw", "temperature_2m")


@_register(_BUCKETED_JOIN)
def bucketed_hourly_join(spark, d):
    """Energy with weather by hour, from tables laid out for it: no side is shuffled."""
    return _bucketed_join(spark, d, "regions")


@_register(_BUCKETED_JOIN, mode="hot")
def bucketed_hourly_join_hot(spark, d):
    """The same where one series holds a third of all rows."""
    return _bucketed_join(spark, d, "hot")


@_register(""",
seen AS (SELECT day, region, load_mw, NULL AS celsius, 1 AS hours FROM energy
         UNION ALL SELECT day, region, NULL, temperature_2m, 0 FROM weather)
SELECT day, region, SUM(hours)::BIGINT AS n_hours, MIN(load_mw) AS min_load_mw, MAX(load_mw) AS max_load_mw,
       MAX(celsius) AS max_temp_c FROM seen GROUP BY ALL HAVING SUM(hours) > 0""", mode="users")
def bucketed_mart(spark, d):
    """Daily load with the day's highest temperature, from tables bucketed by day and series:
    neither the rollups nor their join shuffle."""
    energy, weather = bucketed_pair(spark, d, ["day", "region"], "users")
    load = energy.groupBy("day", "region").agg(F.count(F.lit(1)).alias("n_hours"), F.min("load_mw").alias("min_load_mw"),
                                               F.max("load_mw").alias("max_load_mw"))
    warm = weather.groupBy("day", "region").agg(F.max("temperature_2m").alias("max_temp_c"))
    return load.join(warm, ["day", "region"], "left")
