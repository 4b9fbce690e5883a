"""Conformed dimensions and daily marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.functions.time import as_date
from hourcast.operators import rollups


def dim_date(weather: DataFrame, energy: DataFrame) -> DataFrame:
    """Every day seen in either staging table."""
    return rollups.distinct_keys(weather, energy, column="day")


def dim_region(energy: DataFrame, weather: DataFrame) -> DataFrame:
    """Every region seen in either staging table."""
    return rollups.distinct_keys(energy, weather, column="region")


def fact_energy_daily(energy: DataFrame, audit: bool = True, keys=("region",)) -> DataFrame:
    """Daily load fact: (day, region) -> avg/min/max load, n_hours (int)."""
    out = rollups.daily_rollup(energy, "load_mw", "day", keys)
    return out.withColumn("updated_at", F.current_timestamp()) if audit else out


def mart_weather_daily(std_weather: DataFrame) -> DataFrame:
    """Daily temperature stats with all regions pooled; day_utc is a timestamp."""
    return rollups.pooled_daily(std_weather, "observed_at_utc", "temperature_c", "temp_c")


def mart_energy_weather_daily(std_energy: DataFrame, std_weather: DataFrame) -> DataFrame:
    """Day x region load stats with the day's mean temperature (NULL if none).

    Both sides aggregate to (day_utc, region) before the join, so only one row
    per day and region per side reaches the join shuffle.
    """
    w = (std_weather.groupBy(as_date("observed_at_utc").alias("day_utc"), "region")
         .agg(F.avg("temperature_c").alias("avg_temp_c")))
    e = (std_energy.groupBy(as_date("observed_at_utc").alias("day_utc"), "region")
         .agg(*rollups.stats("load_mw", "load_mw")))
    return (e.join(w, ["day_utc", "region"], "left")
            .select("day_utc", "region", "avg_load_mw", "min_load_mw", "max_load_mw",
                    "avg_temp_c"))
