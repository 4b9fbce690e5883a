"""Joins of hourly series and daily aggregates.

Join strategy is left to AQE: small dimension tables become broadcast hash
joins at run time from their measured size, large ones sort-merge on the keys.
No join is hinted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def hourly_pair(energy: DataFrame, weather: DataFrame, keys: Sequence[str] = ("ts", "region"),
                how: str = "inner") -> DataFrame:
    """Energy x weather on (ts, region): ts, region, load_mw, temperature_2m, day.

    When both sides carry ``day`` (a function of ``ts``) it joins the keys too:
    same result, but a day predicate on either side is propagated to the other
    by the optimizer, so both scans prune the same partitions.
    """
    k = list(keys)
    if "day" not in k and "day" in energy.columns and "day" in weather.columns:
        k.append("day")
    w = weather.select(*k, "temperature_2m")
    return energy.join(w, k, how).select(*keys, "load_mw", "temperature_2m", "day")


def shifted_join(left: DataFrame, right: DataFrame, left_day: str, right_day: str,
                 keys: Sequence[str], days: int = 1, how: str = "inner") -> DataFrame:
    """Join where ``right.right_day = left.left_day + days`` on equal ``keys``."""
    r = right.withColumnRenamed(right_day, "__hc_rday")
    cond = [left[k] == r[k] for k in keys] + \
           [F.date_add(left[left_day], days) == r["__hc_rday"]]
    return left.join(r, cond, how)


def missing_references(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Fact rows whose key is absent from any dimension (each row counted once).

    One left join per dimension plus a single ``IS NULL`` disjunction; a row
    missing from two dimensions still appears once.
    """
    out = fact
    flags = []
    for key, dim in dims.items():
        flag = f"__hc_has_{key}"
        out = out.join(dim.select(key).distinct().withColumn(flag, F.lit(True)), key, "left")
        flags.append(F.col(flag).isNull())
    cond = flags[0]
    for f in flags[1:]:
        cond = cond | f
    return out.filter(cond).drop(*[f"__hc_has_{k}" for k in dims])
