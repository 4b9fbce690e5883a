"""Joins on overlapping spans of time, without a cartesian or nested-loop join.

Spark has no plan for ``a.start <= b.end AND b.start <= a.end`` but trying the pairs of
a key.  Here spans are dealt to time cells and joined on them:

* Cells come in levels, each ``FAN`` times as long as the one below.  A span belongs to the
  lowest level at which it touches at most ``TOUCH`` cells, so a long span is not cut into
  thousands of rows.
* A span is dealt to the cells it touches at its own level and at every higher level that
  the other side uses.  A pair meets at the higher of its two levels, in the cell in which
  the later of the two begins: there, and nowhere else, so every pair comes once.
* The exact condition is checked in the join.

A key with a third of all rows is spread over its cells, and Spark's adaptive skew join
splits a cell that is hot on one side.

Defined results: a span with a NULL key, start or end, or that ends before it starts,
joins nothing; spans of no length are points; repeated rows give repeated pairs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourcast.operators.cells import instant, known, units

FAN, TOUCH, LEVELS = 16, 4, 12
HOUR = dt.timedelta(hours=1)


def _size(cell: int, level: int) -> int:
    return min(cell * FAN ** level, 2 ** 62)


def _level(start: Column, end: Column, cell: int) -> Column:
    """Lowest level at which a span touches at most ``TOUCH`` cells."""
    out = F.lit(LEVELS - 1)
    for level in reversed(range(LEVELS - 1)):
        size = _size(cell, level)
        touched = F.floor(end / F.lit(size)) - F.floor(start / F.lit(size)) + F.lit(1)
        out = F.when(touched <= F.lit(TOUCH), F.lit(level)).otherwise(out)
    return out


def _cell(at: Column, level: Column, cell: int) -> Column:
    sizes = F.array(*[F.lit(_size(cell, i)).cast("bigint") for i in range(LEVELS)])
    return F.floor(at / F.element_at(sizes, level + 1))


def _side(df: DataFrame, k: list[str], start: str, end: str, cell: int, tag: str) -> DataFrame:
    """Rows with their instants and level; only those that can join."""
    s, e = instant(df, start), instant(df, end)
    rows = df.filter(known(df, [*k, start, end])).select(
        *[F.col(c).alias(f"{tag}_{i}") for i, c in enumerate(k)], s.alias(f"{tag}_start"), e.alias(f"{tag}_end"),
        F.struct(*[F.col(c) for c in df.columns]).alias(f"{tag}_row"))
    rows = rows.filter(F.col(f"{tag}_start") <= F.col(f"{tag}_end"))
    return rows.withColumn(f"{tag}_level", _level(F.col(f"{tag}_start"), F.col(f"{tag}_end"), cell))


def _levels(rows: DataFrame, tag: str) -> list[int]:
    """The levels in use, at most ``LEVELS`` numbers."""
    return sorted(r[0] for r in rows.select(f"{tag}_level").distinct().collect())


def _dealt(rows: DataFrame, tag: str, other: list[int], cell: int) -> DataFrame:
    """A row for every level (its own, and the higher ones of the other side) and cell."""
    own = F.col(f"{tag}_level")
    levels = F.array_distinct(F.concat(F.array(own), F.filter(
        F.array(*[F.lit(x) for x in other]), lambda x: x > own)))
    at = rows.withColumn("__hc_level", F.explode(levels))
    first = _cell(F.col(f"{tag}_start"), F.col("__hc_level"), cell)
    last = _cell(F.col(f"{tag}_end"), F.col("__hc_level"), cell)
    return at.withColumn("__hc_cell", F.explode(F.sequence(first, last)))


def overlap_join(left: DataFrame, right: DataFrame, on, left_span: tuple[str, str], right_span: tuple[str, str],
                 touching: bool = True, cell=HOUR, suffix: str = "_right") -> DataFrame:
    """Every pair of rows of equal ``on`` keys whose spans have a time in common.

    Spans are (start column, end column).  ``touching``: both ends belong to a span;
    otherwise a pair that only shares an end does not count (spans that are closed at the
    start and open at the end; a point still lies in a span that it does not end).
    ``cell`` is the length of a cell of the lowest level: about the shortest usual span.
    Columns are those of ``left``, then those of ``right`` but the keys; a name that both
    have gets ``suffix``.
    """
    k = [on] if isinstance(on, str) else list(on)
    size = max(1, units(cell))
    a, b = _side(left, k, *left_span, size, "a"), _side(right, k, *right_span, size, "b")
    in_a, in_b = _levels(a, "a"), _levels(b, "b")
    if not in_a or not in_b:
        in_a, in_b = in_a or [0], in_b or [0]
    a, b = _dealt(a, "a", in_b, size), _dealt(b, "b", in_a, size)
    b = b.withColumnsRenamed({"__hc_level": "__hc_level_b", "__hc_cell": "__hc_cell_b"})
    same = (F.col("__hc_level") == F.col("__hc_level_b")) & (F.col("__hc_cell") == F.col("__hc_cell_b"))
    for i in range(len(k)):
        same = same & (F.col(f"a_{i}") == F.col(f"b_{i}"))
    later = F.greatest("a_start", "b_start")
    here = ((F.col("__hc_level") == F.greatest("a_level", "b_level"))
            & (F.col("__hc_cell") == _cell(later, F.col("__hc_level"), size)))
    if touching:
        meet = (F.col("a_start") <= F.col("b_end")) & (F.col("b_start") <= F.col("a_end"))
    else:
        # the later start lies before both ends, or is itself a point inside the other
        inside = lambda x, y: ((later < F.col(f"{x}_end"))
                               | ((F.col(f"{x}_start") == F.col(f"{x}_end"))
                                  & (F.col(f"{x}_start") >= F.col(f"{y}_start"))))
        meet = inside("a", "b") & inside("b", "a") & (F.col("a_start") <= F.col("b_end")) \
            & (F.col("b_start") <= F.col("a_end"))
    taken = {c.lower() for c in left.columns}
    out = [F.col("a_row")[c].alias(c) for c in left.columns]
    for c in right.columns:
        if c not in k:
            out.append(F.col("b_row")[c].alias(c + suffix if c.lower() in taken else c))
    return a.join(b, same & here & meet).select(*out)


def span_join(points: DataFrame, spans: DataFrame, on, time: str, span: tuple[str, str],
              end_included: bool = True, cell=HOUR, suffix: str = "_right") -> DataFrame:
    """Every pair of a point and a span that holds it: ``start <= time <= end``, or
    ``time < end`` unless ``end_included`` (a span of no length then holds nothing).  See
    :func:`overlap_join`."""
    if not end_included:
        spans = spans.filter(F.col(span[0]) < F.col(span[1]))
    return overlap_join(points, spans, on, (time, time), span, touching=end_included, cell=cell, suffix=suffix)
