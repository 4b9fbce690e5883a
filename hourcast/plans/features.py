"""Demand features: degree-hours and calendar terms on an hourly weather table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.functions.expressions import demand_feature_columns


def demand_features(weather: DataFrame, ts: str = "ts", temperature: str = "temperature_2m",
                    keys: Sequence[str] = ("region",), coefficients: dict | None = None,
                    jitter: bool = False, seed: int = 42, scale: int | None = 6) -> DataFrame:
    """One narrow projection over weather: diurnal, weekend, heating, cooling terms
    and ``demand_mw``.  With ``jitter`` a deterministic keyed noise term is added
    (stable under re-partitioning and retries).
    """
    cols = demand_feature_columns(ts, temperature, coefficients,
                                  jitter_keys=[ts, *keys] if jitter else None, seed=seed)
    out = weather.select(ts, *keys, temperature,
                         *[(F.round(e, scale) if scale is not None else e).alias(n)
                           for n, e in cols.items()])
    return out


def energy_from_weather(weather: DataFrame, time_col: str = "time", **kw) -> DataFrame:
    """raw-energy shaped table (ts, region, load_mw) driven by a raw weather table."""
    f = demand_features(weather, ts=time_col, **kw)
    return f.select(F.col(time_col).alias("ts"), "region", F.col("demand_mw").alias("load_mw"))
