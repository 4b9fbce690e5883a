"""Frames by time: sum, count and mean over the last ``span`` of time, not the last rows.

``RANGE BETWEEN INTERVAL span PRECEDING AND CURRENT ROW``.  Spark's own frame keeps a
series in one task and adds up the whole frame again for every row.  Here a row *enters*
at its time and *leaves* right after ``time + span``, and a frame is a running sum over
both kinds of events, so the work grows with the rows and not with rows x frame.

Events are shuffled by (key, cell of time); what is inside at the start of a cell is the
sum of all events in the cells before it, from a table with one row per (key, cell)
(``cells.sums_before``), and comes in as one more event.  Nothing is copied per row, however
long the span is against a cell, and a series with a third of all rows is spread over its
cells.  By default a series of up to ``CELL_ROWS`` rows is one cell.

Defined results: rows at the same time share a frame; NULL values are not counted, and a
frame without values has NULL sum and mean and count 0; rows with a NULL time form a frame
of their own, as NULLs are peers; a NULL key is a series.  Whole numbers and decimals
are summed exactly.  For floating point, NaN and infinities are counted apart, so one of
them spoils the frames that hold it and no other; sums differ from a frame added up
afresh by rounding only, about 1e-16 of the largest sum of a frame per root of its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, IntegralType

from hourcast.operators.cells import cell_of, cells_needed, instant, sums_before, units

_AT, _CELL, _TURN, _ROW = "__hc_at", "__hc_cell", "__hc_turn", "__hc_row"
_FIRST = -(2 ** 63)


def _measures(df: DataFrame, value: str) -> dict:
    """What is summed for a value: itself, its count, and for floating point the counts of
    NaN and the two infinities."""
    kind, v = df.schema[value].dataType, F.col(value)
    one = lambda c: F.when(c, F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    if isinstance(kind, (FloatType, DoubleType)):
        v = v.cast("double")
        odd = F.isnan(v) | (v == F.lit(float("inf"))) | (v == F.lit(float("-inf")))
        return {"__hc_sum": F.when(v.isNull() | odd, F.lit(0.0)).otherwise(v), "__hc_n": one(v.isNotNull()),
                "__hc_nan": one(F.isnan(v)), "__hc_pos": one(v == F.lit(float("inf"))),
                "__hc_neg": one(v == F.lit(float("-inf")))}
    if isinstance(kind, IntegralType):
        wide = "decimal(38,0)"
    elif isinstance(kind, DecimalType):
        wide = f"decimal(38,{kind.scale})"
    else:
        raise TypeError(f"{value} is {kind.simpleString()}, not a number")
    return {"__hc_sum": F.coalesce(v, F.lit(0)).cast(wide), "__hc_n": one(v.isNotNull())}


def range_stats(df: DataFrame, value: str, span, keys=("region",), order: str = "ts",
                sum_name: str | None = None, count_name: str | None = None, mean_name: str | None = None,
                cell=None) -> DataFrame:
    """``df`` with sum, count and mean of ``value`` over the rows of the same series whose
    time lies in ``[time - span, time]``.

    ``span``: a timedelta, or a whole number for a numeric ``order``.  Names default to
    ``{value}_sum``, ``_count`` and ``_mean``; the sum of whole numbers is a decimal.
    ``cell``: length of a cell, else chosen by a pass over keys and times.
    """
    k = [keys] if isinstance(keys, str) else list(keys)
    reach = units(span)
    length = units(cell) if cell is not None else cells_needed(df, k, order)
    measures = _measures(df, value)
    names = list(measures)

    rows = df.select(*[F.col(c).alias(f"__hc_k{i}") for i, c in enumerate(k)], instant(df, order).alias(_AT),
                     F.struct(*[F.col(c) for c in df.columns]).alias(_ROW), *[e.alias(n) for n, e in measures.items()])
    series = [f"__hc_k{i}" for i in range(len(k))]
    row_type = rows.schema[_ROW].dataType
    none = F.lit(None).cast(row_type)
    enter = F.struct(F.col(_AT).alias(_AT), F.lit(0).alias(_TURN), F.col(_ROW).alias(_ROW),
                     *[F.col(n).alias(n) for n in names])
    leave = F.struct((F.col(_AT) + F.lit(reach)).alias(_AT), F.lit(1).alias(_TURN), none.alias(_ROW),
                     *[(-F.col(n)).cast(rows.schema[n].dataType).alias(n) for n in names])
    both = F.when(F.col(_AT).isNull(), F.array(enter)).otherwise(F.array(enter, leave))
    events = (rows.select(*series, F.explode(both).alias("e")).select(*series, "e.*")
              .withColumn(_CELL, F.when(F.col(_AT).isNotNull(), cell_of(F.col(_AT), length))))

    if length is not None:
        events = events.unionByName(_inside_at_start(rows, series, names, length, reach))
    w = (Window.partitionBy(*series, _CELL).orderBy(_AT, _TURN)
         .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    running = (events
               .select(_ROW, *[F.sum(n).over(w).alias(n) for n in names]).filter(F.col(_ROW).isNotNull()))
    total, n = F.col("__hc_sum"), F.col("__hc_n")
    if "__hc_nan" in names:
        total = (F.when((F.col("__hc_nan") > 0) | ((F.col("__hc_pos") > 0) & (F.col("__hc_neg") > 0)),
                        F.lit(float("nan")))
                 .when(F.col("__hc_pos") > 0, F.lit(float("inf")))
                 .when(F.col("__hc_neg") > 0, F.lit(float("-inf"))).otherwise(total))
    total = F.when(n > 0, total)
    out = {sum_name or f"{value}_sum": total, count_name or f"{value}_count": n,
           mean_name or f"{value}_mean": total / F.when(n > 0, n)}
    return running.select(*[F.col(_ROW)[c].alias(c) for c in df.columns], *[e.alias(x) for x, e in out.items()])


def _inside_at_start(rows: DataFrame, series: list[str], names: list[str], length: int, reach: int) -> DataFrame:
    """One event for every cell with rows: what entered and did not leave before it."""
    # the same without the rows, so that only keys, times and values are read for it
    light = rows.drop(_ROW)
    totals = light.select(*series, F.explode(F.when(F.col(_AT).isNotNull(), F.array(
        F.struct(cell_of(F.col(_AT), length).alias(_CELL), F.lit(1).alias("__hc_own"),
                 *[F.col(n).alias(n) for n in names]),
        F.struct(cell_of(F.col(_AT) + F.lit(reach), length).alias(_CELL), F.lit(0).alias("__hc_own"),
                 *[(-F.col(n)).cast(light.schema[n].dataType).alias(n) for n in names])))).alias("e"))
    cells = totals.select(*series, "e.*").groupBy(*series, _CELL).agg(
        F.max("__hc_own").alias("__hc_own"),
        *[F.sum(n).cast(light.schema[n].dataType).alias(n) for n in names])
    return (sums_before(cells, series, _CELL, names).filter("__hc_own = 1")
               .select(*series, F.lit(_FIRST).alias(_AT), F.lit(-1).alias(_TURN), F.lit(None).cast(rows.schema[_ROW].dataType).alias(_ROW), *names, _CELL))
