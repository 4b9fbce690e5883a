"""Versioned tables of parquet files.

Layout of a table directory::

    data/v=<write>/[<column>=<value>/]part-*.parquet   the files of one write, never changed
    versions/<number>                                  manifests; the highest number is current

A write puts its files below a new ``v=`` directory and then publishes a manifest
-- the list of live directories and the schema -- by renaming a finished file to
the next number.  A reader takes the files of the current manifest, so it sees the
table before or after a write, never between, and a write that dies leaves the
table as it was.  An upsert reads and rewrites the partitions its batch touches;
the manifest carries the others over.  Which partitions exist is known from the
manifest, without calls per partition.

One writer per table at a time.  :func:`vacuum` removes the files of writes that no
kept version needs.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourcast.operators.observed import Watch, WriteGate
from hourcast.operators.quality import GateFailed
from hourcast.operators.upsert import (DuplicateKeyError, asserted_unique, dedupe_batch,
                                       is_duplicate_error, merge_columns, merge_replace,
                                       new_keys_only)


# ------------------------------------------------------------------ file system
def _fs(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does the path exist (Hadoop FileSystem, any scheme)."""
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a directory with all it holds, if it exists."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


# ------------------------------------------------------------------ manifests
class Manifest:
    """The live directories of a table version (relative to ``data``) and its schema."""

    def __init__(self, number: int, column: str | None, dirs: Sequence[str], schema: T.StructType):
        self.number, self.column, self.dirs, self.schema = number, column, list(dirs), schema

    def value_of(self, directory: str) -> str:
        """Partition value, as text, of one directory."""
        return unquote(directory.rpartition("/")[2].partition("=")[2])

    def values(self) -> set[str]:
        return {self.value_of(d) for d in self.dirs} if self.column else set()


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return [int(n) for n in _names(spark, f"{path.rstrip('/')}/versions") if n.isdigit()]


def manifest(spark: SparkSession, path: str, number: int | None = None) -> Manifest | None:
    """The current manifest of a table, or None if nothing was published yet."""
    numbers = _numbers(spark, path)
    if not numbers:
        return None
    number = max(numbers) if number is None else number
    fs, p = _fs(spark, f"{path.rstrip('/')}/versions/{number:012d}")
    stream = fs.open(p)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    m = json.loads(text)
    return Manifest(number, m["column"], m["dirs"], T.StructType.fromJson(m["schema"]))


def publish(spark: SparkSession, path: str, column: str | None, dirs: Sequence[str],
            schema: T.StructType) -> None:
    """Switch the table to a new version: the one step that readers notice."""
    base = f"{path.rstrip('/')}/versions"
    number = max(_numbers(spark, path), default=0) + 1
    text = json.dumps({"column": column, "dirs": sorted(dirs), "schema": json.loads(schema.json())})
    fs, draft = _fs(spark, f"{base}/.draft-{uuid.uuid4().hex}")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    target = _fs(spark, f"{base}/{number:012d}")[1]
    if fs.exists(target) or not fs.rename(draft, target):
        raise RuntimeError(f"another writer published version {number} of {path}")


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Drop all but the last ``keep`` versions and the write directories none of these
    needs; returns the directories removed."""
    numbers = sorted(_numbers(spark, path))
    base = path.rstrip("/")
    live = {d.partition("/")[0] for n in numbers[-keep:] for d in manifest(spark, path, n).dirs}
    gone = [d for d in _names(spark, f"{base}/data") if d.startswith("v=") and d not in live]
    for n in numbers[:-keep]:
        delete_path(spark, f"{base}/versions/{n:012d}")
    for d in gone:
        delete_path(spark, f"{base}/data/{d}")
    return gone


# ------------------------------------------------------------------ reading
def table_exists(spark: SparkSession, path: str) -> bool:
    """Was a version of the table ever published."""
    return bool(_numbers(spark, path))


def read_manifest(spark: SparkSession, path: str, m: Manifest, values=None) -> DataFrame:
    """Rows of a table version; ``values`` limits it to these partitions."""
    dirs = m.dirs
    if values is not None:
        wanted = {str(v) for v in values}
        # a timestamp partition counts as the day it begins
        dirs = [d for d in dirs if m.value_of(d) in wanted or m.value_of(d)[:10] in wanted]
    if not dirs:
        return spark.createDataFrame([], m.schema)
    base = f"{path.rstrip('/')}/data"
    return (spark.read.schema(m.schema).option("basePath", base)
            .parquet(*[f"{base}/{d}" for d in dirs]).select(*m.schema.fieldNames()))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table; a plain parquet directory is read as it is."""
    m = manifest(spark, path)
    return spark.read.parquet(path) if m is None else read_manifest(spark, path, m)


def try_read(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None when no version was published yet."""
    m = manifest(spark, path)
    return None if m is None else read_manifest(spark, path, m)


def read_partitions(spark: SparkSession, path: str, values: Sequence) -> DataFrame:
    """Rows of the given partition values; only their directories are read."""
    m = manifest(spark, path)
    if m is None or m.column is None:
        raise ValueError(f"{path} is not a partitioned table")
    return read_manifest(spark, path, m, values)


def partition_values(spark: SparkSession, path: str) -> set[str]:
    """Partition values of a table, from its manifest (empty if there is none)."""
    m = manifest(spark, path)
    return m.values() if m is not None else set()


# ------------------------------------------------------------------ writing
def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Headered CSV directory (one file per task)."""
    df.write.mode(mode).option("header", True).csv(path)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of a declared schema, cast to its types; a NULL in a column declared
    NOT NULL fails the write.  Both kinds of timestamp pass as they are."""
    out = []
    for f in schema.fields:
        stamps = isinstance(f.dataType, T.TimestampType) and isinstance(
            df.schema[f.name].dataType, (T.TimestampType, T.TimestampNTZType))
        c = F.col(f.name) if stamps else F.col(f.name).cast(f.dataType)
        if not f.nullable:
            failed = F.raise_error(F.lit(f"NULL in column {f.name}, which is NOT NULL"))
            c = F.when(F.col(f.name).isNull(), failed.cast(
                df.schema[f.name].dataType if stamps else f.dataType)).otherwise(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


@dataclass(frozen=True)
class Draft:
    """The files of a write that nobody reads yet, and what was observed while writing."""
    path: str
    column: str | None
    dirs: list[str]
    schema: T.StructType
    metrics: dict

    def publish(self, spark: SparkSession) -> None:
        publish(spark, self.path, self.column, self.dirs, self.schema)


def write_table(df: DataFrame, path: str, partition_by: str | None = None,
                sort_within: Sequence[str] = (), only_present_partitions: bool = False,
                schema: T.StructType | None = None, gates: Sequence[WriteGate] = ()) -> None:
    """Write a new version (TRUNCATE + INSERT, table materialisation).

    With ``only_present_partitions`` the new version replaces just the partitions
    present in ``df`` and keeps the others.  ``sort_within`` orders rows inside each
    file, so parquet statistics let later range predicates skip row groups.
    ``schema`` is the declared schema (see :func:`conform`).  ``gates`` are judged by
    metrics of the write; a fault raises, and the table stays as it was.
    """
    draft_table(df, path, partition_by, sort_within, only_present_partitions, schema, gates).publish(df.sparkSession)


def draft_table(df: DataFrame, path: str, partition_by: str | None = None,
                sort_within: Sequence[str] = (), only_present_partitions: bool = False,
                schema: T.StructType | None = None, gates: Sequence[WriteGate] = ()) -> Draft:
    """Write the files of a new version without switching to it (:func:`write_table`)."""
    spark = df.sparkSession
    if schema is not None:
        df = conform(df, schema)
    before = manifest(spark, path) if only_present_partitions else None
    # number first: names sort by age
    version = f"v={len(_names(spark, f'{path.rstrip(chr(47))}/data')):06d}-{uuid.uuid4().hex}"
    folder = f"{path.rstrip('/')}/data/{version}"
    out_schema = _nullable(df.schema)
    if partition_by:
        # AQE rebalance: roughly advisory-sized output partitions per day --
        # small days are coalesced, a hot day is split -- instead of one file
        # per (task, day).
        df = df.hint("rebalance", partition_by)
    if sort_within:
        df = df.sortWithinPartitions(*([partition_by] if partition_by else []), *sort_within)
    # last of all, in the stage that writes: a task run again does not count twice
    watch = Watch(df, gates) if gates else None
    w = (watch.df if watch else df).write
    (w.partitionBy(partition_by) if partition_by else w).parquet(folder)
    try:
        metrics = watch.check() if watch else {}
    except GateFailed:
        delete_path(spark, folder)
        raise
    if not partition_by:
        return Draft(path, None, [version], out_schema, metrics)
    new = [n for n in _names(spark, folder) if n.startswith(f"{partition_by}=")]
    kept = [d for d in (before.dirs if before else []) if d.rpartition("/")[2] not in set(new)]
    return Draft(path, partition_by, [*kept, *(f"{version}/{n}" for n in new)], out_schema, metrics)


def ensure_table(spark: SparkSession, path: str, schema: T.StructType,
                 partition_by: str | None = None) -> None:
    """Publish an empty table with the declared schema if there is none."""
    if not table_exists(spark, path):
        publish(spark, path, partition_by, [], _nullable(schema))


def _with_defaults(batch: DataFrame, preserve: Sequence[str],
                   defaults: dict[str, Column] | None) -> DataFrame:
    for c in preserve:
        if c not in batch.columns:
            batch = batch.withColumn(c, (defaults or {}).get(c, F.lit(None)))
    return batch


def upsert(spark: SparkSession, batch: DataFrame, path: str, keys: Sequence[str],
           partition_col: str = "day", update: Sequence[str] | None = None,
           preserve: Sequence[str] = (), defaults: dict[str, Column] | None = None,
           dedupe_order: Sequence | None = None,
           schema: T.StructType | None = None, partitions: list | None = None,
           gates: Sequence[WriteGate] = ()) -> None:
    """Insert new keys and update existing ones in the touched partitions.

    ``update=None`` replaces whole rows (DO UPDATE of every column); otherwise
    only ``update`` columns change and ``preserve`` columns keep their first
    value.  Duplicate keys in the batch fail the write, before anything is
    published, unless ``dedupe_order`` is given (last-wins).  ``partition_col`` must
    be a function of the key, so an existing row always lives in the partition its
    batch row targets.  ``partitions`` may list the batch's partition values when
    the caller knows them.  ``gates`` judge the rows that the touched partitions get.
    """
    draft_upsert(spark, batch, path, keys, partition_col, update, preserve, defaults, dedupe_order, schema,
                 partitions, gates).publish(spark)


def draft_upsert(spark: SparkSession, batch: DataFrame, path: str, keys: Sequence[str],
                 partition_col: str = "day", update: Sequence[str] | None = None,
                 preserve: Sequence[str] = (), defaults: dict[str, Column] | None = None,
                 dedupe_order: Sequence | None = None, schema: T.StructType | None = None,
                 partitions: list | None = None, gates: Sequence[WriteGate] = ()) -> Draft:
    """The files of an :func:`upsert`, without switching to them."""
    batch = asserted_unique(batch, keys) if dedupe_order is None else \
        dedupe_batch(batch, keys, dedupe_order)
    m = manifest(spark, path)
    if m is None or not m.dirs:
        merged = _with_defaults(batch, preserve, defaults)
        if m is not None:
            merged = merged.select(*m.schema.fieldNames())
    else:
        if partitions is not None:
            target = read_manifest(spark, path, m, partitions)
        else:
            # the batch's partition values prune the target at run time
            target = read_manifest(spark, path, m).join(
                batch.select(partition_col).distinct(), partition_col, "left_semi")
        if update is None:
            merged = merge_replace(target.select(*m.schema.fieldNames()), batch, keys)
        else:
            merged = merge_columns(target.select(*m.schema.fieldNames()), batch, keys, update,
                                   preserve, defaults)
    try:
        return draft_table(merged, path, partition_col, sort_within=keys, only_present_partitions=True,
                           schema=schema, gates=gates)
    except Exception as e:
        if is_duplicate_error(e):
            raise DuplicateKeyError(f"duplicate key in batch for {path}") from e
        raise


def insert_new(spark: SparkSession, batch: DataFrame, path: str, keys: Sequence[str],
               schema: T.StructType | None = None) -> None:
    """Insert-if-absent: a new version with the batch keys not yet in the table.
    For dimensions, whose rows are few; nothing is written if no key is new."""
    target = try_read(spark, path)
    if target is None:
        write_table(batch.dropDuplicates(list(keys)), path, schema=schema)
        return
    new = new_keys_only(target, batch, keys).select(*target.columns)
    if not new.isEmpty():
        write_table(target.unionByName(new), path, schema=schema)
