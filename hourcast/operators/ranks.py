"""Ranks, percent ranks and tiles over a whole table.

A window without ``PARTITION BY`` sends every row to one task.  Here the rows are dealt to
range partitions by the order and written once; each row is numbered inside its range, and
the numbers start where the ranges before it end.  What comes to the driver is one row per
range: its size, and its first and last value.

Rows that are equal in the order are put in line by the other columns, so a value that a
third of all rows have is cut over several ranges; its rank is that of its first row, which
is carried from range to range.

Defined results: NULLs come first; rows equal in every column stand in for each other; an
empty table gives an empty table; a table of one row has percent rank 0.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourcast.session import checkpoint_dir

_RANGE, _IN, _TIE = "__hc_range", "__hc_in_range", "__hc_in_rank"


def global_ranks(df: DataFrame, order: Sequence[str], rank: str | None = "rank", percent: str | None = None,
                 row_number: str | None = None, tile: str | None = None, tiles: int = 10,
                 ranges: int | None = None) -> DataFrame:
    """``df`` with, where a name is given, ``rank`` and ``percent`` rank by ``order``, and
    ``row_number`` and ``tile`` (``NTILE(tiles)``) by ``order`` and then the other columns.

    ``ranges``: number of range partitions, by default that of a shuffle.
    """
    spark = df.sparkSession
    order = list(order)
    line = [*order, *[f.name for f in df.schema.fields
                      if f.name not in order and "map<" not in f.dataType.simpleString()]]
    if ranges is None:
        ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{checkpoint_dir(spark).rstrip('/')}/hourcast-ranges-{uuid.uuid4().hex}"
    # written, because the ranges are drawn from a sample: every reader must see the same
    (df.repartitionByRange(ranges, *line).withColumn(_RANGE, F.spark_partition_id())
     .write.parquet(path))
    dealt = spark.read.parquet(path)
    value = F.struct(*[F.col(c) for c in order])
    of = dealt.groupBy(_RANGE).agg(F.min(value).alias("lo"), F.max(value).alias("hi"),
                                   F.count(F.lit(1)).alias("n"))
    ends = of.select(F.col(_RANGE).alias("__hc_r"), "lo", "hi", "n")
    same = F.col(_RANGE) == F.col("__hc_r")
    # how many rows of a range have its last value
    last = (dealt.select(_RANGE, value.alias("v")).join(F.broadcast(ends), same & (F.col("v") == F.col("hi")))
            .groupBy("__hc_r").agg(F.count(F.lit(1)).alias("n_hi")))
    begins, total = _begins(ends.join(last, "__hc_r").collect())
    starts = _lookup({k: v[0] for k, v in begins.items()})
    carried = _lookup({k: v[1] for k, v in begins.items()})

    w = Window.partitionBy(_RANGE)
    numbered = dealt.select("*", F.row_number().over(w.orderBy(*line)).alias(_IN),
                            F.rank().over(w.orderBy(*order)).alias(_TIE))
    number = starts + F.col(_IN)
    ranked = F.when(F.col(_TIE) == 1, carried).otherwise(starts + F.col(_TIE))
    out = {}
    if rank:
        out[rank] = ranked
    if percent:
        out[percent] = F.lit(0.0) if total < 2 else (ranked - 1) / F.lit(float(total - 1))
    if row_number:
        out[row_number] = number
    if tile:
        small, more = divmod(total, tiles)
        cut = more * (small + 1)
        first = F.floor((number - 1) / F.lit(small + 1)) + 1
        rest = F.floor((number - 1 - F.lit(cut)) / F.lit(max(small, 1))) + 1 + F.lit(more)
        out[tile] = F.when(number <= F.lit(cut), first).otherwise(rest).cast("bigint")
    return numbered.select(*df.columns, *[e.alias(n) for n, e in out.items()])


def _begins(rows) -> tuple[dict[int, tuple[int, int]], int]:
    """Per range: the rows before it, and the rank of its first value; and all rows."""
    before, value, rank = 0, None, 0
    out = {}
    for r in sorted(rows, key=lambda r: r["__hc_r"]):
        lo, hi = repr(r["lo"]), repr(r["hi"])
        first = rank if lo == value else before + 1
        out[r["__hc_r"]] = (before, first)
        rank = first if hi == lo else before + r["n"] - r["n_hi"] + 1
        value = hi
        before += r["n"]
    return out, before


def _lookup(values: dict[int, int]):
    """The value of a row's range; one entry per range, at most the number of partitions."""
    size = max(values, default=-1) + 1
    array = F.array(*[F.lit(values.get(i, 0)).cast("bigint") for i in range(size)] or [F.lit(0).cast("bigint")])
    return F.element_at(array, F.col(_RANGE) + 1)
