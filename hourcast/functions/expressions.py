"""CASE-style and derived-feature expressions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from hourcast.functions._util import col
from hourcast.functions.time import hour_of_day, iso_weekday


def strip_ws(c) -> Column:
    """Remove leading and trailing whitespace of any kind (spaces, tabs, line
    breaks, Unicode spaces) -- ``F.trim`` removes only the space character."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def is_blank(c) -> Column:
    """NULL, empty or whitespace-only text."""
    return F.coalesce(strip_ws(c) == F.lit(""), F.lit(True))


def default_fill(c, default: str) -> Column:
    """Blank or missing text -> ``default``; the kept value is stripped."""
    return F.coalesce(F.nullif(strip_ws(c), F.lit("")), F.lit(default))


# ISO weekdays that count as weekend (Saturday, Sunday).
WEEKEND_ISO_DAYS = (6, 7)


def day_type(ts, weekend_days: Sequence[int] = WEEKEND_ISO_DAYS) -> Column:
    """'weekend' when the ISO weekday is in ``weekend_days``, else 'weekday'."""
    return F.when(iso_weekday(ts).isin(list(weekend_days)), F.lit("weekend")) \
        .otherwise(F.lit("weekday"))


# Temperature buckets (upper bound exclusive, label), evaluated in
# order; anything not below the last bound -- including NULL -- gets the else label.
TEMP_BUCKETS = ((0.0, "below_0"), (10.0, "0_to_10"), (20.0, "10_to_20"))
TEMP_BUCKET_ELSE = "20_plus"


def bucket(x, bounds: Sequence[tuple[float, str]] = TEMP_BUCKETS,
           else_label: str = TEMP_BUCKET_ELSE) -> Column:
    """Searched CASE: first ``x < bound`` wins; otherwise ``else_label``."""
    c = col(x)
    expr = None
    for bound, label in bounds:
        expr = F.when(c < F.lit(bound), F.lit(label)) if expr is None \
            else expr.when(c < F.lit(bound), F.lit(label))
    return F.lit(else_label) if expr is None else expr.otherwise(F.lit(else_label))


# Demand model coefficients (base MW, diurnal amplitude MW, weekend
# offset MW, heating threshold C and MW per degree below it, cooling threshold C
# and MW per degree above it, jitter amplitude MW).
DEMAND_COEFFICIENTS = {
    "base": 1000.0,
    "diurnal_amplitude": 300.0,
    "weekend_offset": -150.0,
    "heating_threshold": 15.0,
    "heating_slope": 20.0,
    "cooling_threshold": 23.0,
    "cooling_slope": 15.0,
    "jitter_amplitude": 50.0,
}


def demand_feature_columns(ts="ts", temperature="temperature_2m",
                           coefficients: dict | None = None,
                           jitter_keys: Sequence | None = None,
                           seed: int = 42) -> dict[str, Column]:
    """Degree-hour / calendar demand features and their sum.

    diurnal = amplitude * sin(hour / 24 * 2 pi); weekend = offset on ISO days 6,7;
    heating = slope * (threshold - T) below the threshold; cooling likewise above.
    ``demand_mw`` = base + the four terms (+ keyed jitter when ``jitter_keys``).
    """
    k = dict(DEMAND_COEFFICIENTS, **(coefficients or {}))
    t = col(temperature)
    hour = hour_of_day(ts).cast("double")
    diurnal = F.lit(k["diurnal_amplitude"]) * F.sin(hour / F.lit(24.0) * F.lit(2.0)
                                                    * F.lit(math.pi))
    weekend = F.when(iso_weekday(ts).isin(list(WEEKEND_ISO_DAYS)),
                     F.lit(k["weekend_offset"])).otherwise(F.lit(0.0))
    heating = F.when(t < F.lit(k["heating_threshold"]),
                     (F.lit(k["heating_threshold"]) - t) * F.lit(k["heating_slope"])
                     ).otherwise(F.lit(0.0))
    cooling = F.when(t > F.lit(k["cooling_threshold"]),
                     (t - F.lit(k["cooling_threshold"])) * F.lit(k["cooling_slope"])
                     ).otherwise(F.lit(0.0))
    demand = F.lit(k["base"]) + diurnal + weekend + heating + cooling
    cols = {"diurnal_mw": diurnal, "weekend_mw": weekend, "heating_mw": heating,
            "cooling_mw": cooling}
    if jitter_keys:
        from hourcast.functions.numeric import keyed_jitter
        jitter = keyed_jitter(*jitter_keys, seed=seed) * F.lit(k["jitter_amplitude"])
        cols["jitter_mw"] = jitter
        demand = demand + jitter
    cols["demand_mw"] = demand
    return cols
