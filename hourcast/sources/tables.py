"""Named tables, the region reference table and complete-day windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hourcast.functions.time import within_complete_days

# Region code, latitude, longitude.
REGIONS = (
    ("DE-NW", 51.4556, 7.0116),
    ("DE-BY", 48.1351, 11.5820),
    ("DE-BE", 52.5200, 13.4050),
)


def regions_table(spark: SparkSession, regions=REGIONS) -> DataFrame:
    """Small (code, latitude, longitude) reference table; broadcast when joined."""
    return spark.createDataFrame(list(regions), "region string, latitude double, longitude double")


def read_table(spark: SparkSession, path_or_name: str, fmt: str = "parquet") -> DataFrame:
    """A named catalog table, or a table directory written by hourcast sinks."""
    if "/" not in path_or_name and spark.catalog.tableExists(path_or_name):
        return spark.table(path_or_name)
    return spark.read.format(fmt).load(path_or_name)


def complete_days(df: DataFrame, as_of, n_days: int = 30, day_col: str = "day") -> DataFrame:
    """Rows of the last ``n_days`` complete days ending the day before ``as_of``.

    On a day-partitioned table the predicate prunes partitions.
    """
    return df.filter(within_complete_days(day_col, as_of, n_days))
