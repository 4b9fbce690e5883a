"""Processed CSV (``region,time,temperature_2m``; region optional)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourcast.functions.expressions import default_fill, is_blank
from hourcast.functions.numeric import to_double
from hourcast.functions.time import parse_timestamp

DEFAULT_REGION = "DE"


class EmptyInputError(ValueError):
    """No usable rows in the input."""


NEEDED = ("time", "temperature_2m")


def _width(spark: SparkSession, path: str) -> int:
    """Columns of the widest line that may be a header, commas within quotes counted too."""
    line = F.col("value")
    named = [line.contains(c) for c in NEEDED]
    widest = (spark.read.text(path).filter(named[0] & named[1])
              .agg(F.max(F.length(line) - F.length(F.replace(line, F.lit(","), F.lit(""))))).first()[0])
    return (widest or 0) + 1


def _by_name(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all files, each taken by the names in its own file's header."""
    names = [f"__c{i}" for i in range(_width(spark, path))]
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in names])
    lines = (spark.read.schema(schema).csv(path)
             .select(F.array(*names).alias("cells"), F.col("_metadata.file_path").alias("file")))
    trimmed = F.transform("cells", lambda x: F.trim(x))
    is_header = F.lit(True)
    for c in NEEDED:
        is_header = is_header & F.coalesce(F.array_contains(trimmed, c), F.lit(False))
    lines = lines.withColumn("is_header", is_header)
    headers = (lines.filter("is_header").groupBy("file")
               .agg(F.min(F.struct(trimmed.alias("names"))).alias("h"))
               .select(F.col("file").alias("of_file"), F.col("h.names").alias("names")))
    rows = lines.filter("NOT is_header").join(headers, F.col("file") == F.col("of_file"), "left")

    def value(name: str):
        at = F.array_position("names", name).cast("int")
        return F.when(at > 0, F.try_element_at("cells", F.when(at > 0, at)))

    misfit = F.raise_error(F.concat(F.lit("no header with time and temperature_2m in "), F.col("file")))
    return rows.select(
        value("region").alias("region"),
        F.when(F.col("names").isNull(), misfit.cast("string")).otherwise(value("time")).alias("time"),
        value("temperature_2m").alias("temperature_2m"))


def read_processed_csv(spark: SparkSession, path: str, has_region: bool | None = None
                       ) -> DataFrame:
    """Headered all-text CSV scan -> (region, time, temperature_2m) text columns.

    ``has_region=None``: every file's columns are taken *by name* from its own
    header, so files of one folder may differ in column order and in having a
    ``region`` (NULL without); reading a row of a file whose header lacks ``time``
    or ``temperature_2m`` raises.  ``True``/``False`` declare one layout for all
    files (region,time,temperature_2m or time,temperature_2m), which needs one scan
    less; a file with another header raises.
    """
    if has_region is None:
        return _by_name(spark, path)
    cols = (["region"] if has_region else []) + list(NEEDED)
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in cols])
    df = (spark.read.option("header", True).option("enforceSchema", False)
          .schema(schema).csv(path))
    if not has_region:
        df = df.withColumn("region", F.lit(None).cast("string"))
    return df.select("region", *NEEDED)


def parse_weather_rows(df: DataFrame, default_region: str = DEFAULT_REGION,
                       lenient_numbers: bool = False) -> DataFrame:
    """Lenient loader path: blank region -> default (trimmed); rows with blank time
    or temperature are dropped; text cast to typed (time, region, temperature_2m).
    """
    kept = df.filter(~is_blank("time") & F.col("temperature_2m").isNotNull()
                     & (F.col("temperature_2m") != F.lit("")))
    return kept.select(parse_timestamp("time").alias("time"),
                       default_fill("region", default_region).alias("region"),
                       to_double("temperature_2m", lenient=lenient_numbers)
                       .alias("temperature_2m"))


def require_rows(df: DataFrame, what: str = "processed weather CSV") -> DataFrame:
    """Raise when ``df`` has no rows (reads at most one row)."""
    if df.isEmpty():
        raise EmptyInputError(f"No rows found in {what}")
    return df
