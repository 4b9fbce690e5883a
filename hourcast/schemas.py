"""Declared table schemas (never inferred)."""

from pyspark.sql import types as T

S, D, TS, DT, I, L = (T.StringType(), T.DoubleType(), T.TimestampType(),
                      T.DateType(), T.IntegerType(), T.LongType())


def _struct(*fields):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# Landed JSON document: provenance envelope plus one entry per region holding two
# parallel hourly arrays.
META = _struct(("source", S, True), ("timezone", S, True), ("start_date", S, True),
               ("end_date", S, True), ("fetched_at_utc", S, True),
               ("fetched_at_local", S, True))
HOURLY = _struct(("time", T.ArrayType(S), True), ("temperature_2m", T.ArrayType(D), True))
PAYLOAD = _struct(("hourly", HOURLY, True))
REGION_ENTRY = _struct(("region", S, True), ("latitude", D, True), ("longitude", D, True),
                       ("payload", PAYLOAD, True))
LANDING_DOCUMENT = _struct(("_meta", META, True),
                           ("regions", T.ArrayType(REGION_ENTRY), True))

# Processed CSV: all text, cast after the read; region may be absent.
PROCESSED_CSV = _struct(("region", S, True), ("time", S, True), ("temperature_2m", S, True))

RAW_WEATHER = _struct(("time", TS, False), ("region", S, False),
                      ("temperature_2m", D, False), ("created_at", TS, False))
RAW_ENERGY = _struct(("ts", TS, False), ("region", S, False), ("load_mw", D, False),
                     ("created_at", TS, False))
STAGING_WEATHER = _struct(("ts", TS, False), ("region", S, False),
                          ("temperature_2m", D, False), ("day", DT, False),
                          ("updated_at", TS, False))
STAGING_ENERGY = _struct(("ts", TS, False), ("region", S, False), ("load_mw", D, False),
                         ("day", DT, False), ("updated_at", TS, False))
DIM_DATE = _struct(("day", DT, False))
DIM_REGION = _struct(("region", S, False))
FACT_ENERGY_DAILY = _struct(("day", DT, False), ("region", S, False),
                            ("avg_load_mw", D, False), ("min_load_mw", D, False),
                            ("max_load_mw", D, False), ("n_hours", I, False),
                            ("updated_at", TS, False))



def with_day(schema: T.StructType) -> T.StructType:
    """A raw table's declared columns and the day it is partitioned by."""
    return T.StructType([*schema.fields, T.StructField("day", DT, False)])


# Primary keys (enforced by quality checks, not by storage).
KEYS = {
    "raw_weather": ("time", "region"),
    "raw_energy": ("ts", "region"),
    "staging_weather": ("ts", "region"),
    "staging_energy": ("ts", "region"),
    "dim_date": ("day",),
    "dim_region": ("region",),
    "fact_energy_daily": ("day", "region"),
}
