"""Registered queries over tables and gates, each beside its DuckDB SQL.

Gates that must stop a write, batches that must be refused, corrections that stay pending,
named tables, ordered files, and aggregates and comparisons of whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourcast.functions.expressions import bucket
from hourcast.operators import quality as Q
from hourcast.operators.joins import hourly_pair
from hourcast.operators.multiset import difference, except_all, intersect_all
from hourcast.operators.observed import range_gate
from hourcast.operators.ranks import global_ranks
from hourcast.operators.rollups import cube_sets, rollup_sets, subtotals
from hourcast.operators.upsert import DuplicateKeyError
from hourcast.plans import daily, marts as M
from hourcast.plans import oracle as O
from hourcast.plans import registry as R
from hourcast.sinks import tables as sink
from hourcast.sources import csv as csv_src
from hourcast.sources import driver_tables as D
from hourcast.sources.landing import build_documents, read_documents
from hourcast.sources.tables import read_table, regions_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _register(sql: str, name: str | None = None, mode: str = "regions"):
    def add(fn):
        QUERIES[name or fn.__name__] = fn
        ORACLE_SQL[name or fn.__name__] = O._q(sql, mode)
        return fn
    return add


def _stopped(action) -> bool:
    """Was the action stopped by a gate, a repeated key or an empty input."""
    try:
        action()
    except (Q.GateFailed, DuplicateKeyError, csv_src.EmptyInputError):
        return True
    return False


# --- gates and refusals -----------------------------------------------------------------

@_register(""",
orphans AS (SELECT COUNT(*) AS n FROM fact f WHERE NOT EXISTS (
    SELECT 1 FROM dim_date d WHERE d.day = f.day AND d.day < DATE '2024-01-29'))
SELECT 'stale' AS dimension, n AS n_missing, n > 0 AS stopped FROM orphans
UNION ALL SELECT 'whole', 0, FALSE""")
def gate_references_stale(spark, d):
    """The foreign-key gate before a fact write: stopped by a stale date dimension, not by a whole one."""
    energy, weather = R.pair(spark, d)
    fact = M.fact_energy_daily(energy, audit=False)
    whole = {"day": M.dim_date(weather, energy), "region": M.dim_region(energy, weather)}
    stale = whole | {"day": whole["day"].filter(F.col("day") < F.to_date(F.lit(R.CUT_DIM)))}
    rows = [(name, _stopped(lambda dims=dims: Q.gate_references(fact, dims)), dims)
            for name, dims in (("stale", stale), ("whole", whole))]
    out = [Q.missing_dim_report(fact, dims).toDF("n_missing").select(
        F.lit(name).alias("dimension"), F.col("n_missing").cast("bigint").alias("n_missing"),
        F.lit(stopped).alias("stopped")) for name, stopped, dims in rows]
    return out[0].unionByName(out[1])


@_register("""
SELECT ts, region, load_mw + CASE WHEN day >= DATE '2024-01-15' THEN 2 ELSE 0 END AS load_mw, day,
       TRUE AS refused FROM energy""")
def upsert_repeated_keys(spark, d):
    """A batch with every key twice: refused as it is, and taken with the greater load if told so.

    The refused batch must leave the table as it was.
    """
    energy = R._energy(spark, d)
    path = R._scratch(spark, "repeated")
    sink.upsert(spark, energy, path, R.ENERGY_KEYS)
    new = energy.filter(F.col("day") >= F.to_date(F.lit(R.CUT_NEW)))
    batch = new.withColumn("load_mw", F.col("load_mw") + 1.0).unionByName(
        new.withColumn("load_mw", F.col("load_mw") + 2.0))
    refused = _stopped(lambda: sink.upsert(spark, batch, path, R.ENERGY_KEYS))
    untouched = difference(sink.read(spark, path).select(*energy.columns), energy).isEmpty()
    sink.upsert(spark, batch, path, R.ENERGY_KEYS, dedupe_order=["load_mw"])
    return sink.read(spark, path).select("ts", "region", "load_mw", "day", F.lit(refused and untouched).alias("refused"))


@_register("""
SELECT 'range' AS gate, COUNT(*) AS n_rows, count_if(temperature_2m < -40 OR temperature_2m > 45) AS n_faults,
       count_if(temperature_2m < -40 OR temperature_2m > 45) > 0 AS stopped, 0::BIGINT AS n_published
FROM weather_dirty
UNION ALL
SELECT 'clean', COUNT(*), 0, FALSE, COUNT(*) FROM weather""")
def gate_on_write(spark, d):
    """The range gate as a metric of the write: a dirtied table is not published, a clean one is.

    The counts are those that the writes observed.
    """
    gate = range_gate("temperature_2m", -40, 45)
    rows = []
    for name, weather in (("range", R._dirty(spark, d)[1]), ("clean", R._weather(spark, d))):
        path = R._scratch(spark, "gated")
        try:
            draft = sink.draft_table(weather, path, "day", gates=[gate])
            draft.publish(spark)
            seen, stopped = draft.metrics, False
        except Q.GateFailed as e:
            seen, stopped = e.metrics, True
        published = sink.try_read(spark, path)
        n = published.count() if published is not None else 0
        rows.append(F.struct(F.lit(name).alias("gate"), F.lit(seen["n_rows"]).cast("bigint").alias("n_rows"),
                             F.lit(seen["outside_temperature_2m"]).cast("bigint").alias("n_faults"),
                             F.lit(stopped).alias("stopped"), F.lit(n).cast("bigint").alias("n_published")))
    return spark.range(1).select(F.inline(F.array(*rows)))


@_register("SELECT COUNT(*) AS n_hours, TRUE AS stopped FROM weather")
def empty_csv(spark, d):
    """A headered CSV without rows stops the load; the same file layout with all rows does not."""
    _, weather = R.raw_pair(spark, d)
    text = weather.select("region", F.date_format("time", "yyyy-MM-dd'T'HH:mm").alias("time"),
                          F.col("temperature_2m").cast("string").alias("temperature_2m"))
    read = []
    for rows in (text.filter("false"), text):
        path = R._scratch(spark, "maybe-empty")
        sink.write_csv(rows, path)
        read.append(csv_src.parse_weather_rows(csv_src.read_processed_csv(spark, path, has_region=True)))
    stopped = _stopped(lambda: csv_src.require_rows(read[0]))
    return csv_src.require_rows(read[1]).agg(F.count(F.lit(1)).alias("n_hours"), F.lit(stopped).alias("stopped"))


# --- tables --------------------------------------------------------------------------------

@_register("""
SELECT region, CASE region WHEN 'DE-NW' THEN 51.4556::DOUBLE WHEN 'DE-BY' THEN 48.1351::DOUBLE
                           WHEN 'DE-BE' THEN 52.52::DOUBLE END AS latitude,
       CASE region WHEN 'DE-NW' THEN 7.0116::DOUBLE WHEN 'DE-BY' THEN 11.582::DOUBLE
                   WHEN 'DE-BE' THEN 13.405::DOUBLE END AS longitude,
       COUNT(DISTINCT day) AS n_documents, COUNT(*) AS n_hours
FROM weather GROUP BY region""")
def landing_coordinates(spark, d):
    """Landed documents with the coordinates of their region from the reference table."""
    path = R._scratch(spark, "coordinates")
    build_documents(R._weather(spark, d), regions_table(spark)).select("_meta", "regions").write.json(path)
    docs = read_documents(spark, path, multi_line=False).select(F.explode("regions").alias("r"))
    return docs.groupBy("r.region", "r.latitude", "r.longitude").agg(
        F.count(F.lit(1)).alias("n_documents"),
        F.sum(F.size("r.payload.hourly.time")).cast("bigint").alias("n_hours"))


@_register("""
SELECT e.region, CAST(date_trunc('day', e.ts) AS DATE) AS day, COUNT(*) AS n_hours, MAX(w.temperature_2m) AS max_temp,
       MIN(e.load_mw) AS min_load
FROM energy e JOIN weather w ON w.ts = e.ts AND w.region = e.region GROUP BY ALL""")
def named_tables(spark, d):
    """Staging tables under names in the catalog, read by name and by SQL."""
    energy, weather = R.pair(spark, d)
    tag = R._scratch(spark, "named").rpartition("-")[2]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS named_{tag}")
    for name, rows in (("load_hours", energy), ("weather_hours", weather)):
        path = R._scratch(spark, name)
        rows.write.partitionBy("day").parquet(path)
        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
        spark.sql(f"CREATE TABLE named_{tag}.{name} ({fields}) USING parquet PARTITIONED BY (day) LOCATION '{path}'")
        spark.sql(f"MSCK REPAIR TABLE named_{tag}.{name}")
    read_table(spark, f"named_{tag}.weather_hours").createOrReplaceTempView(f"weather_{tag}")
    return spark.sql(f"""
        SELECT e.region, CAST(e.ts AS DATE) AS day, COUNT(*) AS n_hours, MAX(w.temperature_2m) AS max_temp,
               MIN(e.load_mw) AS min_load
        FROM named_{tag}.load_hours e JOIN weather_{tag} w ON w.ts = e.ts AND w.region = e.region AND w.day = e.day
        GROUP BY e.region, CAST(e.ts AS DATE)""")


@_register("SELECT COUNT(*) AS n_rows, 0::BIGINT AS n_inversions FROM energy")
def ordered_files(spark, d):
    """Rows inside the files of an ordered insert follow each other by region and time."""
    path = R._scratch(spark, "ordered")
    sink.write_table(R._energy(spark, d), path, "day", sort_within=["region", "ts"])
    rows = _file_rows(spark, path)
    w = Window.partitionBy("file").orderBy("at")
    before = rows.withColumn("prev", F.lag(F.struct("region", "ts")).over(w))
    return before.agg(F.count(F.lit(1)).alias("n_rows"),
                      F.count_if(F.col("prev") > F.struct("region", "ts")).alias("n_inversions"))


def _file_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all data files of a table with their file and their place in it."""
    files = spark.read.option("recursiveFileLookup", True).parquet(f"{path}/data")
    return files.select("region", "ts", F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.row_index").alias("at"))


@_register(O.PIPELINE_FACT.replace("AS n_hours\n", "AS n_hours, 2 AS failed_runs\n"))
def daily_run_correction_whole(spark, d):
    """After a good load a correction spoils a day: its run stops, and so does a run of another
    day, until the day is repaired.  All days reach the fact."""
    _, raw = R.raw_pair(spark, d)
    wh = R._scratch(spark, "correction")
    other, rest = R._on(raw, "time", "2024-01-02")
    day, _ = R._on(raw, "time", "2024-01-01")
    daily.run(spark, wh, weather=rest, jitter=False)
    spoiled = day.withColumn("temperature_2m", F.lit(50.0))
    failed = sum(_stopped(lambda part=part: daily.run(spark, wh, weather=part, jitter=False))
                 for part in (spoiled, other))
    daily.run(spark, wh, weather=day, jitter=False)
    return R._fact_of(spark, wh).withColumn("failed_runs", F.lit(failed))


# --- aggregates of whole tables ---------------------------------------------------------------

_BUCKETED = O._NULLS.replace("load_mw FROM energy", "load_mw, day, ts AS hour_ts, region AS home FROM energy") + """,
bucketed AS (
    SELECT h.region, h.day, CASE WHEN w.temperature_2m < 0 THEN 'below_0' WHEN w.temperature_2m < 10 THEN '0_to_10'
                                 WHEN w.temperature_2m < 20 THEN '10_to_20' ELSE '20_plus' END AS temp_bucket,
           CAST(ROUND(h.load_mw * 100) AS BIGINT) AS cents
    FROM holes h JOIN weather w ON w.ts = h.hour_ts AND w.region = h.home)
SELECT region, day, temp_bucket, GROUPING_ID(region, day, temp_bucket) AS grouping_id, COUNT(*) AS n_rows,
       CAST(SUM(cents) AS BIGINT) AS sum_cents, MIN(cents) AS min_cents, MAX(cents) AS max_cents
FROM bucketed GROUP BY """


def _bucketed(spark, d) -> DataFrame:
    """Load in cents by region, day and temperature bucket; one region has no name."""
    energy, weather = R.pair(spark, d)
    rows = hourly_pair(energy, weather)
    return rows.select(F.when(F.col("region") != "DE-BE", F.col("region")).alias("region"), "day",
                       bucket("temperature_2m").alias("temp_bucket"),
                       F.round(F.col("load_mw") * 100).cast("bigint").alias("cents"))


_SETS = ["region", "day", "temp_bucket"]


@_register(_BUCKETED + "GROUPING SETS ((region, day, temp_bucket), (region, temp_bucket), (day), ())")
def load_grouping_sets(spark, d):
    """Load by chosen sets of region, day and bucket; the id tells a nameless region from a subtotal."""
    return subtotals(_bucketed(spark, d), _SETS, [_SETS, ["region", "temp_bucket"], ["day"], []], "cents")


@_register(_BUCKETED + "ROLLUP (region, day, temp_bucket)")
def load_rollup(spark, d):
    """Load by region, day and bucket with a subtotal at every step."""
    return subtotals(_bucketed(spark, d), _SETS, rollup_sets(_SETS), "cents")


@_register(_BUCKETED + "CUBE (region, day, temp_bucket)")
def load_cube(spark, d):
    """Load by every subset of region, day and bucket."""
    return subtotals(_bucketed(spark, d), _SETS, cube_sets(_SETS), "cents")


_RANKS = """
SELECT ts, region, load_mw, RANK() OVER (ORDER BY load_mw NULLS FIRST) AS load_rank,
       PERCENT_RANK() OVER (ORDER BY load_mw NULLS FIRST) AS load_percent,
       NTILE(10) OVER (ORDER BY load_mw NULLS FIRST, ts, region) AS decile
FROM {}"""


def _ranked(energy: DataFrame) -> DataFrame:
    return global_ranks(energy.select("ts", "region", "load_mw"), ["load_mw"], rank="load_rank",
                        percent="load_percent", tile="decile")


@_register(_RANKS.format("energy"))
def load_ranks(spark, d):
    """Rank, percent rank and decile of every load over the whole table."""
    return _ranked(R._energy(spark, d))


@_register(_RANKS.format("energy_dirty"))
def load_ranks_dirty(spark, d):
    """The same where many loads are NULL and one day's rows are there twice."""
    return _ranked(R._dirty(spark, d)[0])


@_register(_RANKS.format("energy"), name="load_ranks_by_user", mode="users")
def load_ranks_by_user(spark, d):
    return _ranked(R._energy(spark, d, "users"))


_SIDES = """,
a AS (SELECT region, day, load_mw FROM energy_dirty),
b AS (SELECT NULLIF(region, 'DE-BE') AS region, day, load_mw FROM energy UNION ALL
      SELECT region, day, load_mw FROM energy WHERE hour(ts) % 2 = 0)"""


def _sides(spark, d) -> tuple[DataFrame, DataFrame]:
    dirty, energy = R._dirty(spark, d)[0], R._energy(spark, d)
    nameless = energy.withColumn("region", F.when(F.col("region") != "DE-BE", F.col("region")))
    both = nameless.unionByName(energy.filter(F.hour("ts") % 2 == 0))
    return dirty.select("region", "day", "load_mw"), both.select("region", "day", "load_mw")


@_register(_SIDES + """
SELECT region, day, load_mw, COUNT(*) AS n FROM (FROM a EXCEPT ALL FROM b) GROUP BY ALL""")
def rows_except_all(spark, d):
    """Rows of one table that another does not hold as often, repeated and NULL rows included."""
    return except_all(*_sides(spark, d))


@_register(_SIDES + """
SELECT region, day, load_mw, COUNT(*) AS n FROM (FROM a INTERSECT ALL FROM b) GROUP BY ALL""")
def rows_intersect_all(spark, d):
    """Rows that two tables have in common, as often as both do."""
    return intersect_all(*_sides(spark, d))
