"""As-of join: every row takes the last row of another table at or before its time.

``ASOF JOIN`` of analytical SQL engines, which Spark does not have.  A window over the
union of both tables would do it, but keep a whole series in one task.  Here both
sides are cut into time cells (:mod:`hourcast.operators.cells`):

1. the right side's last row of every (key, cell), with partial aggregation;
2. for the cells that hold left rows, the last of these in any earlier cell
   (``last_before``, over one row per cell);
3. one shuffle of left rows, right rows and carried rows by (key, cell), and one running
   "last value" over each.  The carried row stands first, so no cell reaches into another.

A series with a third of all rows is spread over its cells.  By default the rows of the
longest series are counted first: up to ``CELL_ROWS`` a series is one cell and nothing is
carried, beyond that the length of a cell is chosen so that none holds many more.  A gap
of any length costs nothing.

Defined results: a left row with a NULL key or time matches nothing (kept with NULLs, or
dropped if ``how="inner"``); right rows with a NULL key or time are not matched; of right
rows at the same time the greatest counts, by the order of ``columns``, NULLs being least;
repeated left rows stay.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourcast.operators.cells import cell_of, cells_needed, instant, known, last_before, units

_AT, _CELL, _TURN, _LEFT, _HIT = "__hc_at", "__hc_cell", "__hc_turn", "__hc_left", "__hc_hit"
_FIRST = -(2 ** 63)


def asof_join(left: DataFrame, right: DataFrame, on, left_time: str, right_time: str,
              columns: Sequence[str] | None = None, how: str = "left", allow_exact: bool = True,
              tolerance=None, cell=None) -> DataFrame:
    """``left`` with ``columns`` of the last ``right`` row of the same ``on`` keys whose
    ``right_time`` is not after ``left_time`` (before it, unless ``allow_exact``).

    ``columns`` defaults to all columns of ``right`` but the keys; their names must be
    new to ``left``.  ``tolerance``: a row further back does not match.  ``cell``: length
    of a cell, else chosen by a pass over keys and times of both sides.
    """
    k = [on] if isinstance(on, str) else list(on)
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    names = [c for c in right.columns if c not in k] if columns is None else list(columns)
    clash = {c.lower() for c in left.columns} & {c.lower() for c in names}
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    if cell is None:
        times = left.select(*k, instant(left, left_time).alias(_AT)).unionByName(
            right.select(*k, instant(right, right_time).alias(_AT)))
        length = cells_needed(times.filter(known(times, [*k, _AT])), k, _AT)
    else:
        length = units(cell)

    r = (right.filter(known(right, [*k, right_time]))
         .select(*k, instant(right, right_time).alias(_AT), *names)
         .select(*k, _AT, cell_of(F.col(_AT), length).alias(_CELL), F.struct(_AT, *names).alias(_HIT)))
    whole = F.struct(*[F.col(c) for c in left.columns])
    matchable = known(left, [*k, left_time])
    lf = (left.filter(matchable).select(*k, instant(left, left_time).alias(_AT), whole.alias(_LEFT))
          .withColumn(_CELL, cell_of(F.col(_AT), length)))
    row, hit = lf.schema[_LEFT].dataType, r.schema[_HIT].dataType

    turn = {"right": 0, "left": 1} if allow_exact else {"right": 1, "left": 0}
    both = (lf.select(*k, _AT, _CELL, F.lit(turn["left"]).alias(_TURN), _LEFT, F.lit(None).cast(hit).alias(_HIT))
            .unionByName(r.select(*k, _AT, _CELL, F.lit(turn["right"]).alias(_TURN),
                                  F.lit(None).cast(row).alias(_LEFT), _HIT)))
    if length is not None:
        both = both.unionByName(_carried(lf, r, k))
    w = (Window.partitionBy(*k, _CELL).orderBy(_AT, _TURN, _HIT)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = both.select(_AT, _LEFT, F.last(_HIT, True).over(w).alias(_HIT)).filter(F.col(_LEFT).isNotNull())
    if tolerance is not None:
        near = F.col(_AT) - F.col(f"{_HIT}.{_AT}") <= F.lit(units(tolerance))
        found = found.withColumn(_HIT, F.when(near, F.col(_HIT)))
    if how == "inner":
        found = found.filter(F.col(_HIT).isNotNull())
    out = found.select(f"{_LEFT}.*", *[F.col(_HIT)[c].alias(c) for c in names])
    if how == "inner":
        return out
    alone = left.filter(~matchable).select("*", *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in names])
    return out.unionByName(alone)


def _carried(lf: DataFrame, r: DataFrame, k: list[str]) -> DataFrame:
    """One row for every cell with left rows: the last right row in a cell before it."""
    row, hit = lf.schema[_LEFT].dataType, r.schema[_HIT].dataType
    last = r.groupBy(*k, _CELL).agg(F.max(_HIT).alias(_HIT)).withColumn("__hc_mine", F.lit(False))
    wanted = lf.select(*k, _CELL).distinct().select(
        *k, _CELL, F.lit(None).cast(hit).alias(_HIT), F.lit(True).alias("__hc_mine"))
    cells = last.unionByName(wanted).groupBy(*k, _CELL).agg(
        F.max(_HIT).alias(_HIT), F.bool_or("__hc_mine").alias("__hc_mine"))
    return (last_before(cells, k, _CELL, _HIT, "__hc_carry")
               .filter(F.col("__hc_mine") & F.col("__hc_carry").isNotNull())
               .select(*k, F.lit(_FIRST).alias(_AT), _CELL, F.lit(0).alias(_TURN),
                       F.lit(None).cast(row).alias(_LEFT), F.col("__hc_carry").alias(_HIT)))
