"""Hourly energy and weather series derived from the shared ``events`` table.

The test tables ship no weather or load data, so both hourly series are built
from ``events`` by Spark: events are bucketed to the hour and to a region, and
summed.  Sums are over integers, so every engine gets bit-identical values.

* ``region_mode="regions"`` maps ``user_id % 3`` onto the three region codes --
  the reference's own grain (3 regions x 30 days x 24 hours).
* ``region_mode="users"`` uses ``user_id`` itself as the series key, giving as
  many series as users; this is the scale shape (parallelism grows with keys).
* ``region_mode="hot"`` does so too, but one series holds a third of all users.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.functions.time import trunc_hour, utc_day

# Region codes in user_id % 3 order (0, 1, 2).
REGION_CODES = ("DE-NW", "DE-BY", "DE-BE")
# Event types feeding each series.
ENERGY_EVENT_TYPES = ("purchase", "error", "signup")
WEATHER_EVENT_TYPES = ("view", "click", "signup")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def region_of(user_id: Column, region_mode: str = "regions") -> Column:
    if region_mode == "users":
        return user_id.cast("string")
    if region_mode == "hot":
        return F.when(user_id % F.lit(3) == 0, F.lit("hot")).otherwise(user_id.cast("string"))
    if region_mode != "regions":
        raise ValueError(f"unknown region_mode {region_mode!r}")
    m = user_id % F.lit(3)
    return (F.when(m == 0, F.lit(REGION_CODES[0]))
            .when(m == 1, F.lit(REGION_CODES[1]))
            .otherwise(F.lit(REGION_CODES[2])))


def _hourly(ev: DataFrame, types, region_mode: str) -> DataFrame:
    # Project first so the parquet scan reads only the needed columns and the
    # event_type predicate is pushed into the scan.
    return (ev.filter(F.col("event_type").isin(list(types)))
            .select(trunc_hour("ts", ntz=True).alias("ts"),      # events.ts is NTZ
                    region_of(F.col("user_id"), region_mode).alias("region"),
                    utc_day("ts").alias("day"),
                    "event_id", "value"))


def hourly_energy(ev: DataFrame, region_mode: str = "regions") -> DataFrame:
    """(ts, region, day, load_mw): hourly load in MW, exact to the cent."""
    cents = F.round(F.col("value") * F.lit(100)).cast("bigint")
    return (_hourly(ev, ENERGY_EVENT_TYPES, region_mode)
            .groupBy("ts", "region", "day")
            .agg((F.sum(cents).cast("double") / F.lit(100.0)).alias("load_mw")))


def hourly_weather(ev: DataFrame, region_mode: str = "regions") -> DataFrame:
    """(ts, region, day, temperature_2m) in [-8.0, 31.9] degC."""
    h = _hourly(ev, WEATHER_EVENT_TYPES, region_mode)
    temp = (F.pmod(F.sum("event_id").cast("bigint"), F.lit(400)).cast("double")
            / F.lit(10.0) - F.lit(8.0))
    return h.groupBy("ts", "region", "day").agg(temp.alias("temperature_2m"))


def hourly_both(ev: DataFrame, region_mode: str = "regions"
                ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Energy and weather series from ONE scan and ONE aggregation of events.

    Conditional sums per (hour, region) carry both measures; a cell belongs to a
    series iff it has at least one event of that series' types.  Same values as
    :func:`hourly_energy` / :func:`hourly_weather`, half the event reads.
    Returns (energy, weather, shared aggregate); persist the aggregate when both
    series are written.
    """
    types = sorted(set(ENERGY_EVENT_TYPES) | set(WEATHER_EVENT_TYPES))
    et = F.col("__hc_type")
    h = (ev.filter(F.col("event_type").isin(types))
         .select(trunc_hour("ts", ntz=True).alias("ts"),
                 region_of(F.col("user_id"), region_mode).alias("region"),
                 utc_day("ts").alias("day"), "event_id", "value",
                 F.col("event_type").alias("__hc_type")))
    is_e, is_w = et.isin(list(ENERGY_EVENT_TYPES)), et.isin(list(WEATHER_EVENT_TYPES))
    cents = F.round(F.col("value") * F.lit(100)).cast("bigint")
    agg = h.groupBy("ts", "region", "day").agg(
        F.count_if(is_e).alias("n_e"), F.sum(F.when(is_e, cents)).alias("cents"),
        F.count_if(is_w).alias("n_w"), F.sum(F.when(is_w, F.col("event_id"))).alias("ids"))
    energy, weather = split_hourly(agg)
    return energy, weather, agg


def split_hourly(agg: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(energy, weather) staging shapes from the shared hourly aggregate
    (ts, region, day, n_e, cents, n_w, ids) -- e.g. after it was written once."""
    energy = (agg.filter(F.col("n_e") > 0)
              .select("ts", "region",
                      (F.col("cents").cast("double") / F.lit(100.0)).alias("load_mw"), "day"))
    weather = agg.filter(F.col("n_w") > 0)
    temp = (F.pmod(F.col("ids").cast("bigint"), F.lit(400)).cast("double") / F.lit(10.0)
            - F.lit(8.0))
    weather = weather.select("ts", "region", temp.alias("temperature_2m"), "day")
    return energy, weather


def dirty(energy: DataFrame, weather: DataFrame, duplicate_day: str = "2024-01-15"):
    """A deliberately dirtied copy of the staging pair, derived by Spark.

    NULL load where hour % 7 = 0, -100 degC where hour = 3, and every energy row of
    ``duplicate_day`` twice -- so each quality report has something to find.
    """
    hour = F.hour("ts")
    e = energy.withColumn("load_mw", F.when(hour % 7 == 0, F.lit(None).cast("double"))
                          .otherwise(F.col("load_mw")))
    e = e.unionByName(e.filter(F.col("day") == F.to_date(F.lit(duplicate_day))))
    w = weather.withColumn("temperature_2m", F.when(hour == 3, F.lit(-100.0))
                           .otherwise(F.col("temperature_2m")))
    return e, w


def with_null_keys(energy: DataFrame, day: str = "2024-01-10", hour: int = 5,
                   region: str = "DE-BE") -> DataFrame:
    """A copy with one series of NULL key and one NULL time per series."""
    lost = (F.col("day") == F.to_date(F.lit(day))) & (F.hour("ts") == hour)
    return energy.select(F.when(~lost, F.col("ts")).alias("ts"),
                         F.when(F.col("region") != F.lit(region), F.col("region")).alias("region"),
                         "load_mw")
