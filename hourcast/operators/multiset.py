"""Differences of tables as multisets: ``EXCEPT ALL`` and ``INTERSECT ALL`` with counts.

Both tables are counted row by row in one aggregation, so a repeated row is one row before
the shuffle.  NULL equals NULL and NaN equals NaN, as in GROUP BY; columns are matched by
name and must have the same types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.operators.quality import GateFailed


def _counted(left: DataFrame, right: DataFrame) -> DataFrame:
    if {c: left.schema[c].dataType for c in left.columns} != {c: right.schema[c].dataType for c in right.columns}:
        raise ValueError("both tables need the same columns of the same types")
    sides = left.select("*", F.lit(1).alias("__hc_l"), F.lit(0).alias("__hc_r")).unionByName(
        right.select("*", F.lit(0).alias("__hc_l"), F.lit(1).alias("__hc_r")))
    return sides.groupBy(*left.columns).agg(F.sum("__hc_l").alias("n_left"), F.sum("__hc_r").alias("n_right"))


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every distinct row that the tables do not hold equally often, with ``n_left`` and
    ``n_right``."""
    return _counted(left, right).filter("n_left <> n_right")


def except_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """The distinct rows that ``left`` holds more often, with ``n``, how much more often."""
    return (_counted(left, right).filter("n_left > n_right")
            .select(*left.columns, (F.col("n_left") - F.col("n_right")).alias("n")))


def intersect_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """The distinct rows that both hold, with ``n``, how often both do."""
    return (_counted(left, right).filter("n_left > 0 AND n_right > 0")
            .select(*left.columns, F.least("n_left", "n_right").alias("n")))


def gate_equal(left: DataFrame, right: DataFrame, what: str = "tables") -> None:
    """Fail unless both tables hold the same rows equally often."""
    r = difference(left, right).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*left.columns)).alias("row")).first()
    if r["n"]:
        raise GateFailed(f"{what}: {r['n']} distinct rows differ, the first is {r['row']}")
