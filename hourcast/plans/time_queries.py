"""Registered queries of the operators over time, each beside its DuckDB SQL.

As-of joins, frames by time and joins of spans, over the hourly series (regions, one
series per user, and one series that holds a third of all rows) and over the raw events.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.operators.asof import asof_join
from hourcast.operators.ranges import range_stats
from hourcast.operators.spans import overlap_join, span_join
from hourcast.plans import analysis as A
from hourcast.plans import oracle as O
from hourcast.plans import registry as R
from hourcast.sources import driver_tables as D

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

HOURS_23, DAY, WEEK = dt.timedelta(hours=23), dt.timedelta(days=1), dt.timedelta(days=7)
SHOCK_HOURS, SPIKE_HOURS = 6, 3


def _register(name: str, sql: str, mode: str = "regions"):
    """Register a query under ``name``, with SQL over the prefix of a region mode."""
    def add(fn):
        QUERIES[name] = fn
        ORACLE_SQL[name] = O._q(sql, mode)
        return fn
    return add


def _for_modes(name: str, sql: str, modes=("regions", "users", "hot")):
    """The same query over several region modes: ``name``, ``name_by_user``, ``name_hot``."""
    suffix = {"regions": "", "users": "_by_user", "hot": "_hot"}

    def add(fn):
        for mode in modes:
            def run(spark, d, mode=mode):
                return fn(spark, d, mode)
            run.__doc__ = fn.__doc__
            _register(name + suffix[mode], sql, mode)(run)
        return fn
    return add


# --- as-of joins -------------------------------------------------------------------

_ASOF = """
SELECT e.ts, e.region, e.load_mw, w.ts AS weather_ts, w.temperature_2m
FROM {energy} e ASOF LEFT JOIN weather w ON e.region = w.region AND e.ts >= w.ts"""


def _weather_at(energy: DataFrame, weather: DataFrame) -> DataFrame:
    right = weather.select("region", F.col("ts").alias("weather_ts"), "temperature_2m")
    return asof_join(energy.select("ts", "region", "load_mw"), right, "region", "ts", "weather_ts")


@_for_modes("asof_weather", _ASOF.format(energy="energy"))
def asof_weather(spark, d, mode):
    """Load of every hour with the last weather at or before it, however long ago."""
    return _weather_at(*R.pair(spark, d, mode))


@_register("asof_weather_nulls", O._NULLS + _ASOF.format(energy="holes"))
def asof_weather_nulls(spark, d):
    """The same where some load rows have no region or no time: they match nothing."""
    energy, weather = R.pair(spark, d)
    return _weather_at(D.with_null_keys(energy), weather)


@_register("asof_last_view", """,
views AS (SELECT user_id, ts AS view_ts, max(event_id) AS view_id FROM events WHERE event_type = 'view' GROUP BY ALL)
SELECT p.event_id, p.user_id, p.ts, CASE WHEN p.ts - v.view_ts <= INTERVAL 1 DAY THEN v.view_ts END AS view_ts,
       CASE WHEN p.ts - v.view_ts <= INTERVAL 1 DAY THEN v.view_id END AS view_id
FROM events p ASOF LEFT JOIN views v ON p.user_id = v.user_id AND p.ts > v.view_ts
WHERE p.event_type = 'purchase'""")
def asof_last_view(spark, d):
    """Every purchase with the user's last view before it, if within a day."""
    ev = D.events(spark, d)
    views = ev.filter("event_type = 'view'").select("user_id", F.col("ts").alias("view_ts"),
                                                    F.col("event_id").alias("view_id"))
    buys = ev.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return asof_join(buys, views, "user_id", "ts", "view_ts", allow_exact=False, tolerance=DAY)


# --- frames by time ------------------------------------------------------------------

# in whole cents, so that sums are exact in every engine and order
_CENTS = "CAST(ROUND({} * 100) AS BIGINT)"
_RANGE = f"""
SELECT ts, region, load_mw, CAST(SUM({_CENTS.format("load_mw")}) OVER s AS DOUBLE) / 100.0 AS load_sum,
       COUNT(load_mw) OVER s AS load_count,
       CAST(SUM({_CENTS.format("load_mw")}) OVER s AS DOUBLE) / 100.0 / COUNT(load_mw) OVER s AS load_mean
FROM {{table}} WINDOW s AS (PARTITION BY region ORDER BY ts NULLS FIRST
                          RANGE BETWEEN INTERVAL 23 HOURS PRECEDING AND CURRENT ROW)"""


def _cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("bigint")


def _units(column: str) -> Column:
    return F.col(column).cast("double") / F.lit(100.0)


def _day_before(energy: DataFrame) -> DataFrame:
    out = range_stats(energy.select("ts", "region", "load_mw", _cents("load_mw").alias("cents")), "cents", HOURS_23,
                      sum_name="total", count_name="load_count")
    return out.select("ts", "region", "load_mw", _units("total").alias("load_sum"), "load_count",
                      (_units("total") / F.when(F.col("load_count") > 0, F.col("load_count"))).alias("load_mean"))


@_for_modes("range_24h", _RANGE.format(table="energy"))
def range_24h(spark, d, mode):
    """Sum, count and mean of load over the last 24 hours, with gaps where hours are missing."""
    return _day_before(R.pair(spark, d, mode)[0])


@_register("range_24h_nulls", """,
holes AS (SELECT CASE WHEN NOT (day = DATE '2024-01-10' AND hour(ts) = 5) THEN ts END AS ts,
                 NULLIF(region, 'DE-BE') AS region, load_mw FROM energy_dirty)""" + _RANGE.format(table="holes"))
def range_24h_nulls(spark, d):
    """The same with NULL regions, times and loads, and one day's rows twice."""
    return _day_before(D.with_null_keys(R._dirty(spark, d)[0]))


@_register("range_events_week", """
SELECT event_id, user_id, ts, CAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) OVER s AS DOUBLE) / 100.0 AS value_sum,
       COUNT(value) OVER s AS value_count
FROM events
WINDOW s AS (PARTITION BY CASE WHEN user_id % 3 = 0 THEN -1 ELSE user_id END ORDER BY ts
             RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW)""")
def range_events_week(spark, d):
    """Raw events with the value of the week before them; one group of users is one series."""
    ev = D.events(spark, d).select("event_id", "user_id", "ts", _cents("value").alias("value"), F.when(
        F.col("user_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")).alias("series"))
    out = range_stats(ev, "value", WEEK, keys="series")
    return out.select("event_id", "user_id", "ts", _units("value_sum").alias("value_sum"), "value_count")


# --- spans ------------------------------------------------------------------------------

def _hours(column: str, n: int) -> Column:
    return F.col(column) + F.expr(f"INTERVAL {n} HOURS")


def _shocks(weather: DataFrame) -> DataFrame:
    return A.cold_shock_events(weather).select(
        "region", F.col("ts").alias("shock_ts"), _hours("ts", SHOCK_HOURS).alias("shock_end"), "temp_drop")


@_for_modes("shock_load_hours", O._COLDER + """
SELECT e.ts, e.region, e.load_mw, s.ts AS shock_ts, s.ts + INTERVAL 6 HOURS AS shock_end, s.change AS temp_drop
FROM steps s JOIN energy e ON e.region = s.region AND e.ts BETWEEN s.ts AND s.ts + INTERVAL 6 HOURS
WHERE s.change <= -5""")
def shock_load_hours(spark, d, mode):
    """The load of every hour inside the six hours from a cold shock; these may overlap."""
    energy, weather = R.pair(spark, d, mode)
    return span_join(energy.select("ts", "region", "load_mw"), _shocks(weather), "region", "ts",
                     ("shock_ts", "shock_end"))


@_for_modes("shock_spike_overlap", O._COLDER + """,
jumps AS (SELECT region, ts, load_mw - LAG(load_mw) OVER (PARTITION BY region ORDER BY ts) AS jump FROM energy)
SELECT s.region, s.ts AS shock_ts, j.ts AS spike_ts,
       greatest(s.ts, j.ts) AS both_from, least(s.ts + INTERVAL 6 HOURS, j.ts + INTERVAL 3 HOURS) AS both_to
FROM steps s JOIN jumps j ON j.region = s.region
 AND j.ts < s.ts + INTERVAL 6 HOURS AND s.ts < j.ts + INTERVAL 3 HOURS
WHERE s.change <= -5 AND abs(j.jump) >= 100""", modes=("regions", "hot"))
def shock_spike_overlap(spark, d, mode):
    """Times that lie both within six hours of a cold shock and within three of a load jump."""
    energy, weather = R.pair(spark, d, mode)
    jumps = A.lag_delta_load(energy).filter(F.abs("load_delta_mw") >= 100).select(
        "region", F.col("ts").alias("spike_ts"), _hours("ts", SPIKE_HOURS).alias("spike_end"))
    both = overlap_join(_shocks(weather), jumps, "region", ("shock_ts", "shock_end"), ("spike_ts", "spike_end"),
                        touching=False)
    return both.select("region", "shock_ts", "spike_ts", F.greatest("shock_ts", "spike_ts").alias("both_from"),
                       F.least("shock_end", "spike_end").alias("both_to"))


@_register("errors_between_purchases", """,
buys AS (SELECT user_id, ts AS from_ts, LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS to_ts
         FROM events WHERE event_type = 'purchase')
SELECT e.event_id, e.user_id, e.ts, b.from_ts, b.to_ts
FROM events e JOIN buys b ON e.user_id = b.user_id AND e.ts >= b.from_ts AND e.ts < b.to_ts
WHERE e.event_type = 'error'""")
def errors_between_purchases(spark, d):
    """Errors of a user between two purchases in a row, which may lie minutes or weeks apart."""
    from pyspark.sql import Window
    ev = D.events(spark, d)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    buys = ev.filter("event_type = 'purchase'").select(
        "user_id", F.col("ts").alias("from_ts"), F.lead("ts").over(w).alias("to_ts"))
    errors = ev.filter("event_type = 'error'").select("event_id", "user_id", "ts")
    return span_join(errors, buys, "user_id", "ts", ("from_ts", "to_ts"), end_included=False)
