"""Small DataFrame helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.session import checkpoint_dir

#: At most this many keys are dealt over several parts, so their list may be broadcast.
HOT_KEYS = 1000


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Helper column names that ``df`` does not have, whatever their case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        free = name
        while free.lower() in taken:
            free += "_"
        taken.add(free.lower())
        out.append(free)
    return out


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns that an operator is about to add, whatever their case."""
    gone = {n.lower() for n in names}
    return df.select(*[quoted(c) for c in df.columns if c.lower() not in gone])


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def aside(docs: DataFrame, *also: str, but: Sequence[str | None] = ()):
    """``docs`` with the columns renamed that an operator's helper columns could meet, and
    a function that gives them their names back.  Helper names begin with ``__`` or are
    given in ``also``; the columns ``but`` keep their names."""
    names = {n.lower() for n in also}
    clash = [c for c in docs.columns if (c.startswith("__") or c.lower() in names) and c not in but]
    renamed = dict(zip(clash, fresh(docs, *[f"kept_{i}" for i in range(len(clash))])))

    def back(out: DataFrame) -> DataFrame:
        return out.withColumnsRenamed({new: old for old, new in renamed.items()}) if renamed else out
    return (docs.withColumnsRenamed(renamed) if renamed else docs), back


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for an intermediate table in the folder that all executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/hourcast-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, which cuts its lineage."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hot_parts(rows: DataFrame, key: str, least: int = 256) -> DataFrame:
    """(key, n_parts) of the keys of ``rows`` that must be dealt over several parts.

    A key is hot if it has more rows than both ``least`` and a 1000th of all rows; so
    there are at most ``HOT_KEYS`` of them, and the written table may be broadcast.
    """
    counts = written(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")), "key-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    limit = max(least, -(-total // HOT_KEYS))
    return written(counts.filter((F.col("n") > limit) & F.col(key).isNotNull()).select(
        key, F.ceil(F.col("n") / limit).cast("int").alias("n_parts")), "hot-keys")


def with_part(rows: DataFrame, hot: DataFrame, key: str, spread: Sequence[str], part: str) -> DataFrame:
    """``rows`` with the part of its key that a row belongs to, by a hash of ``spread``."""
    n = F.coalesce("n_parts", F.lit(1))
    return (rows.join(F.broadcast(hot), key, "left")
            .withColumn(part, F.pmod(F.xxhash64(*spread), n).cast("int")).drop("n_parts"))


def in_every_part(rows: DataFrame, hot: DataFrame, key: str, part: str) -> DataFrame:
    """``rows``, one per key, once for every part of its key."""
    parts = F.sequence(F.lit(0), F.coalesce("n_parts", F.lit(1)) - 1)
    return rows.join(F.broadcast(hot), key, "left").withColumn(part, F.explode(parts)).drop("n_parts")
