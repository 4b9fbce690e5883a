"""Bucketed tables: rows laid out by the keys that later joins and aggregations use.

Two tables bucketed alike by their join keys are joined without an Exchange, and a table
bucketed by its group keys is aggregated without one; the shuffle is paid once, when the
table is written.  Bucket keys should spread the rows: (region, ts) or (day, region), not
the region alone, which would put a series with a third of all rows into one bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

BUCKET_ROWS = 2_000_000


def buckets_for(rows: int, per_bucket: int = BUCKET_ROWS, least: int = 8) -> int:
    """A power of two of buckets, so that tables of different sizes can be joined by the
    smaller number."""
    n = least
    while n * per_bucket < rows:
        n *= 2
    return n


def write_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int,
                   sort: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as the external table ``name``, bucketed by ``keys`` and sorted by them
    and ``sort`` inside; returns it as read by name.  One file per bucket."""
    spark = df.sparkSession
    order = [*keys, *[c for c in sort if c not in keys]]
    (df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*order)
     .option("path", path).saveAsTable(name))
    return spark.table(name)
