"""Expose the pipeline's tables in the session catalog under qualified names.

After ``register(spark, layout)`` SQL users query ``raw.weather_hourly``,
``staging.energy_hourly_clean``, ``mart.fact_energy_load_daily`` ... directly,
plus the two standardising model views ``stg_weather_hourly`` and
``stg_energy_hourly``.  Tables are external (LOCATION = the warehouse paths),
so dropping a registration never deletes data; every call registers the directories
of the tables' current versions, so new days become visible.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from hourcast.sinks.tables import manifest

# qualified name -> layout attribute
TABLES = {
    "raw.weather_hourly": "raw_weather",
    "raw.energy_load_hourly": "raw_energy",
    "staging.weather_hourly_clean": "staging_weather",
    "staging.energy_hourly_clean": "staging_energy",
    "mart.dim_date": "dim_date",
    "mart.dim_region": "dim_region",
    "mart.fact_energy_load_daily": "fact",
    "mart.mart_weather_daily": "mart_weather_daily",
    "mart.mart_energy_weather_daily": "mart_energy_weather_daily",
}

VIEWS = {
    "stg_weather_hourly": "SELECT time AS observed_at_utc, region, "
                          "CAST(temperature_2m AS DOUBLE) AS temperature_c FROM raw.weather_hourly",
    "stg_energy_hourly": "SELECT ts AS observed_at_utc, region, CAST(load_mw AS DOUBLE) AS load_mw "
                         "FROM raw.energy_load_hourly",
}


def _drop_external(spark: SparkSession, name: str) -> None:
    kind = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}.get("Type")
    if (kind or "").upper() != "EXTERNAL":
        raise ValueError(f"{name} exists and is not an external table; refusing to replace it")
    spark.sql(f"DROP TABLE {name}")          # external: files are kept


def register(spark: SparkSession, layout) -> list[str]:
    """Create or refresh the external tables and model views; returns the names."""
    done = []
    for db in sorted({n.split(".")[0] for n in TABLES}):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    for name, attr in TABLES.items():
        path = getattr(layout, attr).rstrip("/")
        m = manifest(spark, path)
        if m is None:
            continue
        if spark.catalog.tableExists(name):
            _drop_external(spark, name)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in m.schema.fields)
        if m.column is None:
            where = f"{path}/data/{m.dirs[0]}" if m.dirs else f"{path}/data/none"
            spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{where}'")
        else:
            spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (`{m.column}`) "
                      f"LOCATION '{path}/data'")
            parts = " ".join(f"PARTITION (`{m.column}`='{m.value_of(d)}') LOCATION '{path}/data/{d}'"
                             for d in m.dirs)
            if parts:
                spark.sql(f"ALTER TABLE {name} ADD {parts}")
        done.append(name)
    for view, sql in VIEWS.items():
        src = sql.split(" FROM ")[-1].strip()
        if spark.catalog.tableExists(src):
            spark.sql(f"CREATE OR REPLACE TEMP VIEW {view} AS {sql}")
            done.append(view)
    return done
