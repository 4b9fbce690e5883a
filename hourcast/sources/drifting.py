"""Landed documents whose shape drifts: extra, missing, retyped and broken fields.

Documents are read as text and parsed to VARIANT, so no schema has to fit them all and a
broken one is a row in a report, not a failed job.  Every field is taken out on its own,
by path and type; what does not fit its type is NULL.

Defined results: a document that is no JSON, or has no list of regions, gives no hours; a
region without a name or without both arrays gives none either; all of them are in the
report.  In arrays of unequal length the hours without a partner are dropped, and so is an
hour whose time or temperature cannot be read; numbers written as text count as numbers.
An empty line is no document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROKEN, NO_REGIONS, NO_NAME, NO_ARRAYS, UNEQUAL, FINE = (
    "broken JSON", "no regions", "region without name", "region without arrays", "arrays of unequal length", "fine")


def read_lines(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Documents as text, one per line or one per file: ``document``, ``source_file``."""
    return (spark.read.text(path, wholetext=whole_files)
            .select(F.col("value").alias("document"), F.col("_metadata.file_path").alias("source_file"))
            .filter(F.trim("document") != ""))


def _entries(lines: DataFrame) -> DataFrame:
    """One row per region of a document, or one without a region, with what was found."""
    doc = lines.select("*", F.try_parse_json("document").alias("__doc"))
    regions = F.try_variant_get("__doc", "$.regions", "array<variant>")
    each = doc.select("source_file", F.xxhash64("document").alias("document_hash"),
                      F.col("__doc").isNull().alias("__broken"),
                      F.explode_outer(regions).alias("__r"))
    at = lambda path, kind: F.try_variant_get("__r", path, kind)
    found = each.select(
        "source_file", "document_hash", "__broken", F.col("__r").isNull().alias("__none"),
        at("$.region", "string").alias("region"), at("$.payload.hourly.time", "array<string>").alias("times"),
        F.transform(at("$.payload.hourly.temperature_2m", "array<variant>"),
                    lambda x: F.try_variant_get(x, "$", "double")).alias("temps"))
    status = (F.when(F.col("__broken"), BROKEN).when(F.col("__none"), NO_REGIONS)
              .when(F.coalesce(F.trim("region"), F.lit("")) == "", NO_NAME)
              .when(F.col("times").isNull() | F.col("temps").isNull(), NO_ARRAYS)
              .when(F.size("times") != F.size("temps"), UNEQUAL).otherwise(FINE))
    return found.select("source_file", "document_hash", "region", "times", "temps", status.alias("status"))


def drifting_hours(lines: DataFrame) -> DataFrame:
    """(time, region, temperature_2m) of all hours that can be read."""
    entries = _entries(lines).filter(F.col("status").isin(UNEQUAL, FINE))
    hours = entries.select("region", F.inline(F.arrays_zip("times", "temps")))
    return (hours.select(F.try_to_timestamp(F.col("times")).alias("time"), "region", F.col("temps").alias("temperature_2m"))
            .filter(F.col("time").isNotNull() & F.col("temperature_2m").isNotNull() & ~F.isnan("temperature_2m")))


def drifting_report(lines: DataFrame) -> DataFrame:
    """How many regions of documents were found in which state: status, n."""
    return _entries(lines).groupBy("status").agg(F.count(F.lit(1)).alias("n"))
