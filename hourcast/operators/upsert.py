"""Keyed merge semantics as DataFrame operations (no storage involved).

* replace-on-conflict (``INSERT .. ON CONFLICT DO UPDATE`` of all value columns):
  ``target ANTI JOIN batch  UNION ALL  batch``
* column-selective upsert: updated columns come from the batch, preserved columns
  (e.g. ``created_at``) keep the first-insert value -- one full outer join with
  a match flag, so a NULL in the batch is still an update
* insert-if-absent (``DO NOTHING``): ``batch ANTI JOIN target``

Upserts never delete target rows whose key is absent from the batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    """The same key occurs more than once in one upsert batch."""


DUPLICATE = "duplicate key in batch"


def is_duplicate_error(error: BaseException) -> bool:
    """Did a job fail on :func:`asserted_unique`."""
    return isinstance(error, DuplicateKeyError) or f"{DUPLICATE}:" in str(error)


def asserted_unique(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The batch, failing when it is evaluated if a key repeats.

    The count per key is part of the plan that uses the rows, so the batch is not
    evaluated twice; the rows leave it partitioned by key, as a keyed merge needs.
    """
    values = [c for c in batch.columns if c not in keys]
    one = batch.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__hc_n"),
        F.min_by(F.struct(*[F.col(c) for c in values]) if values else F.lit(1),
                 F.lit(0)).alias("__hc_v"))
    first = keys[0]
    named = F.concat(F.lit(f"{DUPLICATE}: "), F.to_json(F.struct(*[F.col(k) for k in keys])))
    checked = F.when(F.col("__hc_n") == 1, F.col(first)).otherwise(
        F.raise_error(named).cast(batch.schema[first].dataType))
    return one.select(checked.alias(first), *[F.col(k) for k in keys[1:]],
                      *[F.col(f"__hc_v.{c}").alias(c) for c in values]).select(*batch.columns)


def duplicate_keys(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once, with their multiplicity."""
    return batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def dedupe_batch(batch: DataFrame, keys: Sequence[str],
                 order: Sequence[Column] | str | None = None) -> DataFrame:
    """Enforce one row per key in a batch.

    ``order=None`` (default): fail if any key repeats -- a single statement may
    not touch the same row twice.  Otherwise keep the last row by ``order``
    (last-wins) with ``max_by`` per key: an aggregate, so each map task first
    reduces its own duplicates and a key repeated millions of times never
    gathers in one task.  ``order="unique"`` skips the check for batches unique
    by construction (a group-by output, or a table already keyed the same way).
    """
    if isinstance(order, str) and order == "unique":
        return batch
    if order is None:
        dup = duplicate_keys(batch, keys).limit(1).collect()
        if dup:
            raise DuplicateKeyError(f"{DUPLICATE}: {dup[0].asDict()}")
        return batch
    rank = F.struct(*[o if isinstance(o, Column) else F.col(o) for o in order])
    values = [c for c in batch.columns if c not in keys]
    last = F.max_by(F.struct(*[F.col(c) for c in values]), rank).alias("__hc_last")
    return (batch.groupBy(*keys).agg(last)
            .select(*keys, *[F.col(f"__hc_last.{c}").alias(c) for c in values])
            .select(*batch.columns))


def merge_replace(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in the batch, plus every batch row."""
    cols = target.columns
    kept = target.join(batch.select(*keys), list(keys), "left_anti")
    return kept.select(*cols).unionByName(batch.select(*cols))


def merge_columns(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                  update: Sequence[str], preserve: Sequence[str] = (),
                  defaults: dict[str, Column] | None = None) -> DataFrame:
    """Column-selective upsert.

    For a matched key: ``update`` columns from the batch, ``preserve`` columns
    from the target.  New keys: batch values, with ``defaults`` filling preserved
    columns the batch lacks (e.g. ``created_at = now()``).  Unmatched target rows
    pass through unchanged.  Other columns the batch carries (e.g. a partition
    column derived from the key) follow the batch like ``update`` columns.
    """
    defaults = defaults or {}
    t = target.withColumn("__hc_t", F.lit(True))
    b = batch.withColumn("__hc_b", F.lit(True))
    j = t.alias("t").join(b.alias("b"), list(keys), "full_outer")
    in_b = F.col("b.__hc_b").isNotNull()
    in_t = F.col("t.__hc_t").isNotNull()
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in preserve:
            new_val = F.col(f"b.{c}") if c in batch.columns else defaults.get(c, F.lit(None))
            out.append(F.when(in_t, F.col(f"t.{c}")).otherwise(new_val).alias(c))
        elif c in update or c in batch.columns:
            out.append(F.when(in_b, F.col(f"b.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.col(f"t.{c}"))
    return j.select(*out)


def new_keys_only(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows (one per key) whose key is not yet in the target."""
    return batch.dropDuplicates(list(keys)).join(target.select(*keys), list(keys), "left_anti")


def insert_if_absent(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target after ``INSERT .. ON CONFLICT DO NOTHING``."""
    return target.unionByName(new_keys_only(target, batch, keys).select(*target.columns))
