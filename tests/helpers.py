import datetime as dt

from pyspark.sql import functions as F


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def energy_df(spark, rows):
    """rows: (ts_str, region, load_mw) -> staging energy frame."""
    df = spark.createDataFrame([(ts(t), r, v) for t, r, v in rows],
                               "ts timestamp, region string, load_mw double")
    return df.withColumn("day", F.to_date("ts"))


def weather_df(spark, rows):
    df = spark.createDataFrame([(ts(t), r, v) for t, r, v in rows],
                               "ts timestamp, region string, temperature_2m double")
    return df.withColumn("day", F.to_date("ts"))


def collect_sorted(df, *cols):
    return [tuple(r) for r in df.orderBy(*cols).collect()] if cols else \
        sorted(tuple(r) for r in df.collect())
