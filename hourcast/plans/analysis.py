"""Analytical queries over the staging pair (energy, weather).

Inputs: ``energy`` (ts, region, load_mw, day) and ``weather``
(ts, region, temperature_2m, day).  ``keys`` names the series key columns
(default the region).  ``chunk`` picks the row-window shape (see
``hourcast.operators.windows``): by default the skew-safe shape that serves every
size; ``None`` is the plain window.

Results are unordered; :func:`in_order` sorts one the way its report is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.functions.expressions import bucket, day_type
from hourcast.functions.numeric import relative_change, round_double, safe_divide
from hourcast.operators import rollups
from hourcast.operators.joins import hourly_pair, shifted_join
from hourcast.operators.windows import (CALENDAR, lag_delta, rolling_mean, top_n_per_group,
                                        with_window_columns)

COLD_SHOCK_DROP = -5.0
JOINT_TEMP_DROP = -3.0
JOINT_LOAD_RISE = 5.0


# Row order of each report: column, or (column, "desc").
ORDERS = {
    "cold_shock_events": ("region", "ts"),
    "peak_hour_by_region": ("region",),
    "peak_hour_mode": (("n_regions", "desc"), "hour_of_day"),
    "rolling_24": ("ts", "region"),
    "lag_delta": ("ts", "region"),
    "top3_hours": (("day", "desc"), "region", "load_rank_in_day", "ts"),
    "temp_buckets": ("region", "temp_bucket"),
    "joint_cold_shock": ("ts", "region"),
    "n_hours_reconciliation": (("day", "desc"), "region"),
}


def order_of(name: str) -> list:
    """Sort expressions of a report, NULLs last ascending and first descending."""
    return [F.col(c[0]).desc_nulls_first() if isinstance(c, tuple) else F.col(c).asc_nulls_last()
            for c in ORDERS[name]]


def in_order(name: str, df: DataFrame, numbered: bool = False) -> DataFrame:
    """``df`` sorted as the report ``name``.  ``numbered`` adds ``row_no`` (from 1);
    that window needs all rows in one partition, so it is for finished reports only."""
    if numbered:
        from pyspark.sql import Window
        return df.withColumn("row_no", F.row_number().over(Window.orderBy(*order_of(name))).cast("bigint"))
    return df.orderBy(*order_of(name))


def _k(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def cold_shock_events(weather: DataFrame, threshold: float = COLD_SHOCK_DROP,
                      keys=("region",), chunk=CALENDAR) -> DataFrame:
    """Hours whose temperature fell by at least |threshold| since the previous row."""
    k = _k(keys)
    d = lag_delta(weather.select("ts", "day", *k, "temperature_2m"), "temperature_2m",
                  keys=k, prev_name=False, delta_name="temp_drop", chunk=chunk)
    return (d.filter(F.col("temp_drop") <= F.lit(threshold))
            .select(*k, "ts", "day", "temperature_2m", "temp_drop"))


def shock_days(weather: DataFrame, threshold: float = COLD_SHOCK_DROP, keys=("region",),
               chunk=CALENDAR) -> DataFrame:
    """One row per (region, day) with a cold shock."""
    k = _k(keys)
    ev = cold_shock_events(weather, threshold, k, chunk)
    return ev.select(*k, F.col("day").alias("shock_day")).distinct()


def next_day_load_increase(energy: DataFrame, weather: DataFrame,
                           threshold: float = COLD_SHOCK_DROP, keys=("region",),
                           chunk=CALENDAR) -> DataFrame:
    """Mean relative change of daily load from a shock day to the next day.

    Both joins are inner: shock days without load on that or the next day are
    not counted in ``n_events``.  The daily-load aggregate is joined twice and
    its exchange is reused.
    """
    k = _k(keys)
    s = shock_days(weather, threshold, k, chunk)
    daily = energy.groupBy("day", *k).agg(F.avg("load_mw").alias("avg_load_mw"))
    d0 = daily.select(F.col("day").alias("shock_day"), *k,
                      F.col("avg_load_mw").alias("load_shock_day_avg"))
    j0 = s.join(d0, [*k, "shock_day"])
    d1 = daily.select(*k, "day", F.col("avg_load_mw").alias("load_next_day_avg"))
    j1 = shifted_join(j0, d1, "shock_day", "day", k)
    rate = relative_change(F.col("load_shock_day_avg"), F.col("load_next_day_avg"))
    return j1.agg(F.avg(rate).alias("avg_next_day_increase_rate"),
                  F.count(F.lit(1)).alias("n_events"))


def peak_hours(energy: DataFrame, keys=("region",)) -> DataFrame:
    """Top-1 hour of day by average load per series (ties -> earlier hour)."""
    k = _k(keys)
    prof = rollups.hour_profile(energy, "load_mw", "ts", k)
    top = top_n_per_group(prof, k, [F.col("avg_load_mw").desc_nulls_first(),
                                     F.col("hour_of_day").asc()],
                          n=1, method="row_number")
    return top.select(*k, "hour_of_day", "avg_load_mw")


def peak_hour_by_region(energy: DataFrame, keys=("region",), scale: int = 6) -> DataFrame:
    k = _k(keys)
    return peak_hours(energy, k).select(*k, "hour_of_day",
                                        round_double("avg_load_mw", scale).alias("avg_load_mw"))


def peak_hour_mode(energy: DataFrame, keys=("region",)) -> DataFrame:
    """How many series peak at each hour of day."""
    return (peak_hours(energy, keys).groupBy("hour_of_day")
            .agg(F.count(F.lit(1)).alias("n_regions")))


def weekday_weekend_pivot(energy: DataFrame, keys=("region",)) -> DataFrame:
    """Average load per (series, day type), pivoted with ``MAX(..) FILTER``:
    one row per series with ``weekday_avg`` and ``weekend_avg``."""
    k = _k(keys)
    tagged = energy.select(*k, "load_mw", day_type("ts").alias("day_type"))
    agg = tagged.groupBy(*k, "day_type").agg(F.avg("load_mw").alias("avg_load_mw"))
    return agg.groupBy(*k).agg(
        rollups.filtered_max("avg_load_mw", F.col("day_type") == "weekday").alias("weekday_avg"),
        rollups.filtered_max("avg_load_mw", F.col("day_type") == "weekend").alias("weekend_avg"))


def weekend_effect(energy: DataFrame, keys=("region",), scale: int = 6) -> DataFrame:
    """Mean over series of (weekend avg - weekday avg) and of its rate.

    Each series weighs the same; a series lacking one day type contributes NULL
    and is skipped by the mean.  The per-type averages come from one
    aggregation by series with conditional averages -- the same values as
    averaging per (series, day type) and pivoting, one shuffle fewer.
    """
    k = _k(keys)
    weekend = day_type("ts") == F.lit("weekend")
    per_series = energy.groupBy(*k).agg(
        F.avg(F.when(~weekend, F.col("load_mw"))).alias("weekday_avg"),
        F.avg(F.when(weekend, F.col("load_mw"))).alias("weekend_avg"))
    diff = F.col("weekend_avg") - F.col("weekday_avg")
    return per_series.agg(
        round_double(F.avg(diff), scale).alias("avg_diff_mw"),
        round_double(F.avg(safe_divide(diff, F.col("weekday_avg"))), scale)
        .alias("avg_diff_rate"))


def hourly_join(energy: DataFrame, weather: DataFrame, limit: int | None = 48) -> DataFrame:
    """Energy x weather per hour and region, first ``limit`` rows by (ts, region)."""
    j = hourly_pair(energy, weather)
    j = j.orderBy("ts", "region")
    return j.limit(limit) if limit else j


def rolling_24(energy: DataFrame, n_rows: int = 24, keys=("region",),
               chunk=CALENDAR, scale: int | None = 6) -> DataFrame:
    """Mean load over the current and previous ``n_rows - 1`` rows."""
    k = _k(keys)
    name = "load_roll24h_mw"
    r = rolling_mean(energy.select("ts", *k, "load_mw"), "load_mw", n_rows, keys=k,
                     name=name, chunk=chunk)
    return r.withColumn(name, round_double(name, scale)) if scale is not None else r


def lag_delta_load(energy: DataFrame, keys=("region",), chunk=CALENDAR
                   ) -> DataFrame:
    """Previous row's load and the hour-over-row change."""
    k = _k(keys)
    return lag_delta(energy.select("ts", *k, "load_mw"), "load_mw", keys=k,
                     prev_name="load_prev_mw", delta_name="load_delta_mw", chunk=chunk)


def top_hours(energy: DataFrame, n: int = 3, keys=("region",)) -> DataFrame:
    """Hours ranked by load within each (day, series), ties kept (dense rank)."""
    k = _k(keys)
    r = top_n_per_group(energy.select("day", "ts", *k, "load_mw"), ["day", *k],
                        [F.col("load_mw").desc_nulls_first()], n=n, method="dense_rank",
                        rank_name="load_rank_in_day")
    return r.withColumn("load_rank_in_day", F.col("load_rank_in_day").cast("bigint"))


def temp_buckets(energy: DataFrame, weather: DataFrame, keys=("region",)) -> DataFrame:
    """Load stats per series and temperature bucket."""
    k = _k(keys)
    j = hourly_pair(energy, weather, keys=("ts", *k))
    b = j.select(*k, "load_mw", bucket("temperature_2m").alias("temp_bucket"))
    return rollups.group_stats(b, [*k, "temp_bucket"], "load_mw", "load_mw", "n_hours")


def joint_cold_shock(energy: DataFrame, weather: DataFrame,
                     temp_drop: float = JOINT_TEMP_DROP, load_rise: float = JOINT_LOAD_RISE,
                     keys=("region",), chunk=CALENDAR) -> DataFrame:
    """Hours with a temperature drop and a load rise versus the previous joined row.

    The lags are taken after the join, so a row missing on either side changes
    what "previous" means.
    """
    k = _k(keys)
    j = hourly_pair(energy, weather, keys=("ts", *k)).drop("day")

    def build(w):  # both lags share one window spec -> one sort, one Window node
        return {"__hc_pt": F.lag("temperature_2m").over(w),
                "__hc_pl": F.lag("load_mw").over(w)}
    # the join feeds the count and the row branch: it is written once
    t = with_window_columns(j, k, "ts", 1, build, chunk=chunk, materialize=True)
    t = t.select("*", (F.col("temperature_2m") - F.col("__hc_pt")).alias("temp_delta_c"),
                 (F.col("load_mw") - F.col("__hc_pl")).alias("load_delta_mw"))
    return (t.filter((F.col("temp_delta_c") <= F.lit(temp_drop))
                     & (F.col("load_delta_mw") >= F.lit(load_rise)))
            .select("ts", *k, "temperature_2m", "temp_delta_c", "load_mw", "load_delta_mw"))
