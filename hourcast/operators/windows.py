"""Row-based window operators over keyed series.

``LAG`` is the previous *row* and the rolling mean covers the previous N *rows*
(a gap in the series is not filled).  Rows follow each other by time, NULL times
first; a NULL key is a series of its own, and no row is ever left out.

By default (``chunk="calendar"``) the longest series is measured, by one pass with
partial aggregation over keys and times.  If it has at most ``block_rows`` rows, a window
partition is a series.  Otherwise a partition is a series within a time cell
(:mod:`hourcast.operators.cells`): rows are shuffled once by (series, cell), and a cell
gets copies of the last rows before it, as many as the frame reaches back.  These come
from a table of the last k rows of every cell, which a group limit cuts before its
shuffle; a cell with fewer than k rows passes older ones on.  So a series with a third
of all rows is spread over its cells, and a burst makes the cells shorter.  Both shapes
give the same rows.

``chunk=None`` is one plain window partitioned by the series key; a Column or a list of
Columns, coarse to fine and monotone in the order, gives the cells.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourcast.functions._util import col
from hourcast.operators.cells import CELL_ROWS, cell_of, cells_needed, instant, null_safe_join

_IDX, _CELL, _HALO = "__hc_idx", "__hc_cell", "__hc_halo"

CALENDAR = "calendar"


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def chunk_levels(order: str, chunk) -> list[Column]:
    """Chunk expressions from coarse to fine."""
    if isinstance(chunk, str):
        if chunk != CALENDAR:
            raise ValueError(f"chunk must be None, {CALENDAR!r} or Columns, not {chunk!r}")
        return [F.to_date(F.col(order)), F.hour(F.col(order))]
    return [chunk] if isinstance(chunk, Column) else list(chunk)


def row_indexed(df: DataFrame, keys, order: str, chunk=CALENDAR) -> DataFrame:
    """Add a 0-based row index per series, computed without a per-series sort.

    1. row_number inside (keys, chunk levels)                -- parallel over chunks
    2. running sums of the chunk counts, level by level      -- one row per chunk
    3. index = sums before the chunk + row_number - 1
    The counts read only the key and order columns, with partial aggregation.
    """
    k = _keys(keys)
    levels = chunk_levels(order, chunk)
    parts = [f"__hc_c{i}" for i in range(len(levels))]
    c = df.withColumns(dict(zip(parts, levels)))
    c = c.withColumn("__hc_rn", F.row_number().over(Window.partitionBy(*k, *parts).orderBy(order)))
    counts = (df.select(*k, *[e.alias(p) for p, e in zip(parts, levels)])
              .groupBy(*k, *parts).agg(F.count(F.lit(1)).alias("__hc_n")))
    offsets = counts
    for i in reversed(range(len(parts))):
        to = parts[:i + 1]
        level = counts if i == len(parts) - 1 else \
            counts.groupBy(*k, *to).agg(F.sum("__hc_n").alias("__hc_n"))
        before = (Window.partitionBy(*k, *parts[:i]).orderBy(parts[i])
                  .rowsBetween(Window.unboundedPreceding, -1))
        level = level.select(*k, *to, F.coalesce(F.sum("__hc_n").over(before), F.lit(0))
                             .alias(f"__hc_o{i}"))
        offsets = level if i == len(parts) - 1 else null_safe_join(offsets, level, [*k, *to])
    first = reduce(lambda a, b: a + b, [F.col(f"__hc_o{i}") for i in range(len(parts))])
    offsets = offsets.select(*k, *parts, first.alias("__hc_off"))
    return (null_safe_join(c, offsets, [*k, *parts])
            .withColumn(_IDX, F.col("__hc_off") + F.col("__hc_rn") - F.lit(1))
            .drop(*parts, "__hc_rn", "__hc_off"))


def _cell_of(df: DataFrame, keys: list[str], order: str, chunk, block_rows: int) -> Column | None:
    """The cell of a row, or None if every series is one partition."""
    if isinstance(chunk, str):
        chunk_levels(order, chunk)                       # only the known name
        length = cells_needed(df, keys, order, block_rows)
        return None if length is None else cell_of(instant(df, order), length)
    levels = chunk_levels(order, chunk)
    return levels[0] if len(levels) == 1 else F.struct(*levels)


def with_window_columns(df: DataFrame, keys, order: str, halo: int,
                        build: Callable[[Window], dict[str, Column]],
                        chunk=CALENDAR, block_rows: int = CELL_ROWS,
                        materialize: bool = False) -> DataFrame:
    """Evaluate row-frame window columns reaching at most ``halo`` rows back.

    ``build(w)`` returns {name: expression over window spec w}; ``w`` is ordered
    and partitioned for the chosen shape.  ``materialize``: first write the input
    once with ``DataFrame.checkpoint()`` (the session's shared checkpoint folder),
    so an expensive input is not computed again for measuring and for the copied rows.
    """
    k = _keys(keys)
    if chunk is not None and materialize:
        from hourcast.session import checkpoint_dir
        checkpoint_dir(df.sparkSession)          # the cluster's folder; set only if unset
        df = df.checkpoint(eager=True)
    cell = None if chunk is None else _cell_of(df, k, order, chunk, block_rows)
    if cell is None:
        w = Window.partitionBy(*k).orderBy(order)
        return df.select("*", *[e.alias(n) for n, e in build(w).items()])
    # rows at the same time follow each other in one order everywhere
    rest = [f.name for f in df.schema.fields if f.name not in (order, *k)
            and "map<" not in f.dataType.simpleString()]
    rows = df.withColumn(_CELL, cell)
    tails = (rows.withColumn("__hc_back", F.row_number().over(
                 Window.partitionBy(*k, _CELL).orderBy(F.desc(order), *map(F.desc, rest))))
             .filter(F.col("__hc_back") <= F.lit(halo)))
    # the last rows of all cells in a line: a row is wanted by every cell whose first row
    # is one of the next ``halo`` in it
    line = Window.partitionBy(*k).orderBy(_CELL, order, *rest)
    begins = ~F.col(_CELL).eqNullSafe(F.lag(_CELL).over(line))
    wanted = F.collect_list(F.when(F.col("__hc_begins"), F.col(_CELL))).over(line.rowsBetween(1, max(halo, 1)))
    copies = (tails.withColumn("__hc_begins", begins).withColumn("__hc_to", wanted)
              .select(*df.columns, F.explode("__hc_to").alias(_CELL), F.lit(True).alias(_HALO)))
    spread = rows.withColumn(_HALO, F.lit(False)).unionByName(copies)
    exprs = build(Window.partitionBy(*k, _CELL).orderBy(order, *rest))
    out = spread.select(*df.columns, _HALO, *[e.alias(n) for n, e in exprs.items()])
    return out.filter(~F.col(_HALO)).drop(_HALO)


def lag_delta(df: DataFrame, value: str, keys=("region",), order: str = "ts",
              prev_name: str | None = None, delta_name: str | None = None,
              offset: int = 1, chunk=CALENDAR, **kw) -> DataFrame:
    """Previous row's value (``LAG(value, offset)``) and ``value - previous``.

    Either output can be suppressed by passing ``False`` as its name.  The first
    ``offset`` rows of a series get NULL.  The lag is evaluated once; the delta
    is a projection over it.
    """
    prev = prev_name or (f"{value}_prev" if prev_name is None else "__hc_prev")
    out = with_window_columns(df, keys, order, offset,
                              lambda w: {prev: F.lag(value, offset).over(w)},
                              chunk=chunk, **kw)
    if delta_name is not False:
        out = out.withColumn(delta_name or f"{value}_delta", col(value) - F.col(prev))
    return out.drop("__hc_prev") if prev_name is False else out


def rolling_mean(df: DataFrame, value: str, n_rows: int = 24, keys=("region",),
                 order: str = "ts", name: str | None = None,
                 chunk=CALENDAR, **kw) -> DataFrame:
    """Mean of the current and ``n_rows - 1`` preceding rows (partial at start)."""
    def build(w):
        return {name or f"{value}_roll{n_rows}":
                F.avg(value).over(w.rowsBetween(-(n_rows - 1), 0))}
    return with_window_columns(df, keys, order, n_rows - 1, build, chunk=chunk, **kw)


def top_n_per_group(df: DataFrame, partition: Sequence[str], order: Sequence[Column],
                    n: int = 1, method: str = "row_number",
                    rank_name: str = "rn") -> DataFrame:
    """Rows ranked within ``partition`` by ``order``, keeping rank <= n.

    ``row_number`` keeps exactly n (pass a tie-break in ``order`` for
    determinism); ``dense_rank`` keeps ties.  The filter on the rank lets
    Catalyst insert a per-partition group limit before the shuffle.
    """
    fn = {"row_number": F.row_number, "dense_rank": F.dense_rank, "rank": F.rank}[method]
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(rank_name, fn().over(w)).filter(F.col(rank_name) <= F.lit(n))
