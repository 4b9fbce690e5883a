"""Time cells of keyed series, for operators that must not hold a series in one task.

A series is cut into cells of equal length in time; (key, cell) is the unit that is
shuffled and sorted.  What a cell needs from before it is carried in as extra rows, from
a table with one row per (key, cell).

Times are timestamps of either kind, dates, or whole numbers; lengths are given as
``timedelta`` for the former and as whole numbers for the latter.  Inside, both are
64-bit integers (microseconds or the number itself).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

DAY = dt.timedelta(days=1)
#: Rows of the longest series that :func:`cell_length` puts into a cell.
CELL_ROWS = 100_000
#: Cells whose last values are settled together by :func:`last_before`.
FAN = 256


def units(length) -> int:
    """A length of time in the units of :func:`instant`."""
    if isinstance(length, dt.timedelta):
        length = length // dt.timedelta(microseconds=1)
    if not isinstance(length, int) or length < 0:
        raise ValueError(f"a length is a timedelta or a whole number, not negative: {length!r}")
    return length


def instant(df: DataFrame, column: str) -> Column:
    """The times of ``column`` as 64-bit integers."""
    if isinstance(df.schema[column].dataType, IntegralType):
        return F.col(column).cast("bigint")
    return F.unix_micros(F.col(column).cast("timestamp"))


def cell_of(at: Column, length: int | None) -> Column:
    """Number of the cell that an instant lies in; without a length all are one cell."""
    if length is None:
        return F.lit(0).cast("bigint")
    return F.floor(at / F.lit(length)) if length > 1 else at


def known(df: DataFrame, columns: Sequence[str]) -> Column:
    """All of ``columns`` are there: rows with a NULL key or time match nothing."""
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).isNotNull()
    return out


def longest_series(df: DataFrame, keys: Sequence[str], time: str) -> tuple[int, int]:
    """(rows of the longest series, the time it spans).  One pass with partial
    aggregation; two numbers come back."""
    spans = (df.select(*keys, instant(df, time).alias("__hc_at")).groupBy(*keys)
             .agg(F.count(F.lit(1)).alias("n"),
                  (F.max("__hc_at") - F.min("__hc_at") + F.lit(1)).alias("span")))
    r = spans.agg(F.max("n").alias("n"), F.max_by("span", "n").alias("span")).first()
    return r["n"] or 0, r["span"] or 1


def cell_length(df: DataFrame, keys: Sequence[str], time: str, rows: int = CELL_ROWS,
                longest: tuple[int, int] | None = None) -> int:
    """A length at which no cell holds many more than ``rows`` rows.

    Starts from the mean density of the longest series; while the fullest cell holds more
    than four times ``rows`` (a burst, or a denser series), cells get shorter and the rows
    are counted again, with partial aggregation.  One number comes back from each pass.
    """
    n, span = longest or longest_series(df, keys, time)
    length = max(1, span * rows // max(n, 1))
    while n > 4 * rows and length > 1:
        counts = df.select(*keys, cell_of(instant(df, time), length).alias("__hc_cell"))
        counts = counts.filter(F.col("__hc_cell").isNotNull()).groupBy(*keys, "__hc_cell").count()
        fullest = counts.agg(F.max("count")).first()[0] or 0
        if fullest <= 4 * rows:
            break
        length = max(1, length * rows // fullest)
    return length


def cells_needed(df: DataFrame, keys: Sequence[str], time: str, rows: int | None = None) -> int | None:
    """:func:`cell_length`, or None if no series has more than ``rows`` rows."""
    rows = CELL_ROWS if rows is None else rows
    longest = longest_series(df, keys, time)
    return None if longest[0] <= rows else cell_length(df, keys, time, rows, longest)


def last_before(cells: DataFrame, keys: Sequence[str], cell: str, value: str, name: str,
                levels: int = 1) -> DataFrame:
    """``cells``, one row per (keys, cell), with ``name``: the last ``value`` that is not
    NULL among the cells of the series before this one.

    ``FAN`` cells are settled together; their last values are carried on over a table
    that is ``FAN`` times smaller, ``levels`` times over.
    """
    k = list(keys)
    before = lambda w: F.last(value, True).over(
        w.orderBy(cell).rowsBetween(Window.unboundedPreceding, -1))
    if not levels:
        return cells.withColumn(name, before(Window.partitionBy(*k)))
    up = f"{cell}_{levels}"
    grouped = cells.withColumn(up, F.floor(F.col(cell) / F.lit(FAN)))
    tops = grouped.groupBy(*k, up).agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), F.col(cell))).alias(value))
    carried = last_before(tops, k, up, value, f"{name}_{levels}", levels - 1).drop(value)
    inside = grouped.withColumn(name, before(Window.partitionBy(*k, up)))
    return (inside.join(carried, [*k, up])
            .withColumn(name, F.coalesce(name, f"{name}_{levels}")).drop(up, f"{name}_{levels}"))


def sums_before(cells: DataFrame, keys: Sequence[str], cell: str, values: Sequence[str],
                levels: int = 1) -> DataFrame:
    """``cells``, one row per (keys, cell), with each of ``values`` replaced by its sum over
    the cells of the series before this one (0 for the first).  NULL keys are one series."""
    k = list(keys)

    def before(w):
        w = w.orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
        return {v: F.coalesce(F.sum(v).over(w), F.lit(0)).cast(cells.schema[v].dataType) for v in values}
    if not levels:
        return cells.withColumns(before(Window.partitionBy(*k)))
    up = f"{cell}_{levels}"
    grouped = cells.withColumn(up, F.floor(F.col(cell) / F.lit(FAN)))
    tops = grouped.groupBy(*k, up).agg(*[F.sum(v).cast(cells.schema[v].dataType).alias(v) for v in values])
    tops = sums_before(tops, k, up, values, levels - 1).withColumnsRenamed({v: f"{v}_{levels}" for v in values})
    both = null_safe_join(grouped.withColumns(before(Window.partitionBy(*k, up))), tops, [*k, up])
    return (both.withColumns({v: F.col(v) + F.col(f"{v}_{levels}") for v in values})
            .drop(up, *[f"{v}_{levels}" for v in values]))


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on equal keys where NULL equals NULL; the key columns appear once."""
    renamed = right.select(*[F.col(k).alias(f"__hc_r{i}") for i, k in enumerate(keys)],
                           *[c for c in right.columns if c not in keys])
    on = reduce(lambda a, b: a & b,
                [F.col(k).eqNullSafe(F.col(f"__hc_r{i}")) for i, k in enumerate(keys)])
    return left.join(renamed, on).drop(*[f"__hc_r{i}" for i in range(len(keys))])
