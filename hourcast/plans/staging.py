"""Raw -> staging projections (and the standardising model views)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.functions.time import utc_day


def _audit(df: DataFrame, audit: bool, name: str = "updated_at") -> DataFrame:
    return df.withColumn(name, F.current_timestamp()) if audit else df


def stage_weather(raw: DataFrame, audit: bool = True, time_col: str = "time") -> DataFrame:
    """raw weather (time, region, temperature_2m) -> (ts, region, temperature_2m, day)."""
    out = raw.select(F.col(time_col).alias("ts"), "region", "temperature_2m",
                     utc_day(time_col).alias("day"))
    return _audit(out, audit)


def stage_energy(raw: DataFrame, audit: bool = True) -> DataFrame:
    """raw energy (ts, region, load_mw) -> (ts, region, load_mw, day)."""
    out = raw.select("ts", "region", "load_mw", utc_day("ts").alias("day"))
    return _audit(out, audit)


def standard_weather(raw: DataFrame, time_col: str = "time") -> DataFrame:
    """Model view: observed_at_utc, region, temperature_c (double)."""
    return raw.select(F.col(time_col).alias("observed_at_utc"), "region",
                      F.col("temperature_2m").cast("double").alias("temperature_c"))


def standard_energy(raw: DataFrame) -> DataFrame:
    """Model view: observed_at_utc, region, load_mw (double)."""
    return raw.select(F.col("ts").alias("observed_at_utc"), "region",
                      F.col("load_mw").cast("double").alias("load_mw"))
