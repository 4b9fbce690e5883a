"""The daily pipeline as plain function calls over table directories.

Stage order (each stage reads what the previous one wrote):

1. ingest   landed JSON documents (or processed CSV) -> typed hourly weather
            (structural document checks / pre-load gate first); the batch is written
            once to a folder of the warehouse and read from there
2. raw      upsert ``raw/weather_hourly`` on (time, region): temperature updated,
            ``created_at`` keeps its first-insert value
3. energy   measured load: upsert ``raw/energy_load_hourly`` on (ts, region); modelled
            load: rebuild its touched days by the demand model over raw weather
4. staging  upsert ``staging/weather_hourly_clean`` and ``staging/energy_hourly_clean``
            on (ts, region), touched days only, from the raw tables; the weather range
            and the row count are gates on metrics of these writes, judged before either
            table is switched to its new files
5. gates    energy duplicates and the expected row count, before anything downstream
            is written
6. marts    insert-if-absent dimensions, foreign-key gate, then the daily fact and the
            days of the pooled weather mart and of the energy x weather mart
7. tests    model tests on these days of the marts (fail-fast), then quality reports

A run works on its days -- those of the weather batch and of the measured load -- and on
*pending* days.  Its days are noted as pending before anything is loaded, and struck out
when the marts have passed their tests; so a day that a gate or a failure stopped, be it
new or a correction, is staged and judged again by every run, keeps failing runs until it
is repaired, and is then taken up.  Every table is versioned (``hourcast.sinks.tables``)
and partitioned by its day column, dimensions apart: a run reads its days and the
dimensions only.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast import schemas
from hourcast.functions.time import utc_day, within_complete_days
from hourcast.operators import quality as Q
from hourcast.operators.upsert import DuplicateKeyError
from hourcast.plans import marts as M
from hourcast.plans.concurrent import run_all
from hourcast.plans.features import energy_from_weather
from hourcast.operators.observed import Watch, WriteGate, ingest_gate, range_gate
from hourcast.plans.ingest import weather_from_landing
from hourcast.sources.csv import parse_weather_rows, read_processed_csv, require_rows
from hourcast.plans.staging import stage_energy, stage_weather, standard_energy, standard_weather
from hourcast.session import configure
from hourcast.sinks import tables as sink

WEATHER_RANGE = (-40.0, 45.0)
LOAD_RANGE = (0.0, 5000.0)
SPIKE_THRESHOLD = 400.0

ENERGY_WEATHER_MART_TESTS = [
    ("not_null", "day_utc"), ("not_null", "region"), ("not_null", "avg_load_mw"),
    ("unique_combination", ["day_utc", "region"]),
    ("expression_is_true", "avg_load_mw > 0"),
]
WEATHER_MART_TESTS = [("not_null", "day_utc"), ("unique", "day_utc")]


@dataclass
class Layout:
    warehouse: str

    def __getattr__(self, name):  # raw_weather -> <warehouse>/raw/weather_hourly ...
        paths = {
            "raw_weather": "raw/weather_hourly",
            "raw_energy": "raw/energy_load_hourly",
            "staging_weather": "staging/weather_hourly_clean",
            "staging_energy": "staging/energy_hourly_clean",
            "dim_date": "mart/dim_date",
            "dim_region": "mart/dim_region",
            "fact": "mart/fact_energy_load_daily",
            "mart_weather_daily": "mart/mart_weather_daily",
            "mart_energy_weather_daily": "mart/mart_energy_weather_daily",
            "pending": "pending_days",
            "reports": "reports",
        }
        if name not in paths:
            raise AttributeError(name)
        return f"{self.warehouse.rstrip('/')}/{paths[name]}"


@dataclass
class RunResult:
    layout: Layout
    reports: Mapping[str, DataFrame] = field(default_factory=dict)


def _read(spark: SparkSession, path: str, days: list | None) -> DataFrame:
    """A day-partitioned table, or just some days of it."""
    if days is None:
        return sink.read(spark, path)
    return sink.read_partitions(spark, path, days)


def batch_profile(batch: DataFrame, time_col: str = "time") -> tuple[list, int, dict | None]:
    """One aggregate pass over a batch: its calendar days, the largest
    multiplicity of a (time, region) key and one key with that multiplicity.
    The day list is bounded by the calendar, not by the rows."""
    per_key = batch.groupBy(time_col, "region").agg(F.count(F.lit(1)).alias("n"),
                                                    F.first(utc_day(time_col)).alias("day"))
    r = per_key.agg(F.collect_set("day").alias("days"), F.max("n").alias("max_n"),
                    F.max_by(F.struct(time_col, "region"), F.col("n")).alias("worst")).first()
    if r is None or r["max_n"] is None:
        return [], 0, None
    return sorted(r["days"]), int(r["max_n"]), r["worst"].asDict()


def checked_days(batch: DataFrame, what: str, time_col: str = "time") -> list:
    """The days of a batch; raises if a key repeats."""
    days, most, worst = batch_profile(batch, time_col)
    if most > 1:
        raise DuplicateKeyError(f"duplicate key in {what} batch ({most} rows): {worst}")
    return days


def pending_days(spark: SparkSession, layout: Layout) -> list[str]:
    """Days that a run took up and has not brought into the marts, because a gate or a
    failure stopped it.  Bounded by the calendar."""
    pending = sink.try_read(spark, layout.pending)
    return sorted(r[0] for r in pending.distinct().collect()) if pending is not None else []


def set_pending(spark: SparkSession, layout: Layout, days: list[str]) -> None:
    """Note the days that must be brought into the marts before others count as done."""
    rows = spark.range(1).select(F.explode(F.array(*map(F.lit, days)).cast("array<string>")).alias("day"))
    sink.write_table(rows, layout.pending)


def load_weather(spark: SparkSession, layout: Layout, weather: DataFrame,
                 days: list | None = None) -> None:
    """Raw weather upsert keeping ``created_at`` from the first insert."""
    batch = weather.withColumn("day", utc_day("time"))
    sink.upsert(spark, batch, layout.raw_weather, ["time", "region"], update=["temperature_2m"],
                preserve=["created_at"], defaults={"created_at": F.current_timestamp()},
                partitions=days, schema=schemas.with_day(schemas.RAW_WEATHER))


def load_energy(spark: SparkSession, layout: Layout, energy: DataFrame, days: list | None = None
                ) -> None:
    """Raw upsert of measured load, keeping ``created_at`` from the first insert."""
    batch = energy.select("ts", "region", "load_mw", utc_day("ts").alias("day"))
    sink.upsert(spark, batch, layout.raw_energy, ["ts", "region"], update=["load_mw"],
                preserve=["created_at"], defaults={"created_at": F.current_timestamp()},
                partitions=days, schema=schemas.with_day(schemas.RAW_ENERGY))


def model_energy(spark: SparkSession, layout: Layout, jitter: bool = True,
                 days: list | None = None) -> None:
    """Rebuild raw energy (TRUNCATE + INSERT) from raw weather by the demand model.

    With ``days`` only those day partitions are replaced.  The load is a pure
    function of the weather row (keyed jitter, not a random stream), so rebuilding
    only the touched days gives the same table as a full rebuild.
    """
    raw_w = _read(spark, layout.raw_weather, days)
    load = energy_from_weather(raw_w.drop("day", "created_at"), time_col="time",
                               jitter=jitter, scale=None)
    out = load.select("ts", "region", "load_mw", F.current_timestamp().alias("created_at"),
                      utc_day("ts").alias("day"))
    sink.write_table(out, layout.raw_energy, "day", sort_within=["region", "ts"],
                     only_present_partitions=days is not None,
                     schema=schemas.with_day(schemas.RAW_ENERGY))


def stage(spark: SparkSession, layout: Layout, weather_days: list | None = None,
          energy_days: list | None = None, modelled: list | None = None) -> None:
    """Raw -> staging upserts on (ts, region) of the given days, or of everything: two
    independent writes, submitted together and gated by their own metrics.

    The temperature range is a gate of the weather write; the days whose load was
    ``modelled`` must get one energy row per weather row.  Neither table is switched to
    its new files before both writes have passed.  Days without a raw table yet are
    skipped.
    """
    mine = F.col("day").cast("string").isin([str(d) for d in modelled or []])
    counted = WriteGate({"n_modelled": Q.count_where(mine)}, lambda m: None)

    def one(raw: str, make, target: str, days, schema, *gates) -> Callable[[], sink.Draft]:
        rows = _read(spark, raw, days).drop("day", "created_at")
        return lambda: sink.draft_upsert(spark, make(rows), target, ["ts", "region"], dedupe_order="unique",
                                         partitions=days, schema=schema, gates=[counted, *gates])

    jobs = []
    if weather_days is None or weather_days:
        jobs.append(one(layout.raw_weather, stage_weather, layout.staging_weather, weather_days,
                        schemas.STAGING_WEATHER, range_gate("temperature_2m", *WEATHER_RANGE)))
    if (energy_days is None or energy_days) and sink.table_exists(spark, layout.raw_energy):
        jobs.append(one(layout.raw_energy, stage_energy, layout.staging_energy, energy_days,
                        schemas.STAGING_ENERGY))
    drafts = run_all(*jobs)
    if modelled and len(drafts) == 2:
        hours, loads = (d.metrics["n_modelled"] for d in drafts)
        if hours != loads:
            raise Q.GateFailed(f"row count == {hours}: failed, {loads} modelled rows")
    for draft in drafts:
        draft.publish(spark)


def gate_staging(spark: SparkSession, layout: Layout, expected_rows: int | None = None,
                 days: list | None = None) -> None:
    """Fail-fast gates that need a query of their own: duplicates on the given days, and
    ``expected_rows`` of the whole staging energy table."""
    gates = [lambda: Q.gate_unique(_read(spark, layout.staging_energy, days), ["ts", "region"])]
    if expected_rows is not None:
        gates.append(lambda: Q.gate_rowcount(sink.read(spark, layout.staging_energy),
                                             expected_rows))
    run_all(*gates)


def build_marts(spark: SparkSession, layout: Layout, days: list | None = None) -> None:
    """Dimensions first, then the foreign-key gate, then fact and marts together.

    Every output is limited to the given days: dimensions get only new keys, the
    fact is upserted per day, and both marts replace just their day partitions.
    """
    sw = _read(spark, layout.staging_weather, days)
    se = _read(spark, layout.staging_energy, days)
    rw = _read(spark, layout.raw_weather, days).drop("day", "created_at")
    re_ = _read(spark, layout.raw_energy, days).drop("day", "created_at")
    std_w, std_e = standard_weather(rw), standard_energy(re_)
    run_all(
        lambda: sink.insert_new(spark, M.dim_date(sw, se), layout.dim_date, ["day"],
                                schemas.DIM_DATE),
        lambda: sink.insert_new(spark, M.dim_region(se, sw), layout.dim_region, ["region"],
                                schemas.DIM_REGION))
    fact = M.fact_energy_daily(se)
    Q.gate_references(fact.select("day", "region"), dimensions(spark, layout))
    run_all(
        # a group-by output: one row per key, no duplicate check needed
        lambda: sink.upsert(spark, fact, layout.fact, ["day", "region"], dedupe_order="unique",
                            partitions=days, schema=schemas.FACT_ENERGY_DAILY),
        lambda: sink.write_table(M.mart_weather_daily(std_w), layout.mart_weather_daily,
                                 "day_utc", only_present_partitions=days is not None),
        lambda: sink.write_table(M.mart_energy_weather_daily(std_e, std_w),
                                 layout.mart_energy_weather_daily, "day_utc",
                                 only_present_partitions=days is not None))


def dimensions(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    return {"day": sink.read(spark, layout.dim_date), "region": sink.read(spark, layout.dim_region)}


def test_marts(spark: SparkSession, layout: Layout, days: list | None = None) -> None:
    """Model tests on the given days of both marts."""
    run_all(lambda: Q.gate_tests(_read(spark, layout.mart_energy_weather_daily, days),
                                 ENERGY_WEATHER_MART_TESTS, "mart_energy_weather_daily"),
            lambda: Q.gate_tests(_read(spark, layout.mart_weather_daily, days), WEATHER_MART_TESTS,
                                 "mart_weather_daily"))


class LazyReports(Mapping):
    """Report name -> DataFrame, built on first access (reports are optional
    reading; building one can run a size check, so nothing is built unasked)."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders, self._built = builders, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def quality_reports(spark: SparkSession, layout: Layout, expected_rows: int | None = None
                    ) -> LazyReports:
    """Validation and quality reports (never fail), built lazily by name.  Without
    ``expected_rows`` the drift report expects days x 24 x series of the table."""
    sw = lambda: sink.read(spark, layout.staging_weather)
    se = lambda: sink.read(spark, layout.staging_energy)
    fact = lambda: sink.read(spark, layout.fact)
    dims = lambda: dimensions(spark, layout)
    return LazyReports({
        "fact_grain": lambda: Q.grain_report(fact(), ["day", "region"], total="fact_rows"),
        "missing_dim_keys": lambda: Q.missing_dim_report(fact(), dims()),
        "n_hours_reconciliation": lambda: Q.reconcile_counts(fact(), se()),
        "value_order": lambda: Q.value_order_report(fact()),
        "fact_nulls": lambda: Q.null_report(fact(), ["day", "region", "avg_load_mw",
                                                     "min_load_mw", "max_load_mw", "n_hours",
                                                     "updated_at"]),
        "energy_profile": lambda: Q.table_profile(se(), ["ts", "region"],
                                                  ["ts", "region", "load_mw", "day"],
                                                  {"load_mw": LOAD_RANGE}),
        "weather_profile": lambda: Q.table_profile(sw(), ["ts", "region"],
                                                   ["ts", "region", "temperature_2m", "day"],
                                                   {"temperature_2m": WEATHER_RANGE}),
        "load_spikes": lambda: Q.spike_report(se(), "load_mw", SPIKE_THRESHOLD, 20),
        "rowcount_drift": lambda: Q.rowcount_drift(se(), expected_rows),
    })


def run(spark: SparkSession, warehouse: str, landing: str | None = None,
        csv: str | None = None, weather: DataFrame | None = None,
        energy: DataFrame | None = None, expected_rows: int | None = None,
        jitter: bool = True, incremental: bool = True,
        register_tables: bool = False, as_of=None, n_days: int = 30) -> RunResult:
    """One pipeline run.  Give exactly one weather input: ``landing`` (JSON
    documents), ``csv`` (processed CSV) or ``weather`` (a typed DataFrame with
    time, region, temperature_2m).  ``energy`` (ts, region, load_mw) is measured
    load; without it raw energy is rebuilt from weather by the demand model.

    ``incremental`` limits every stage after the raw load to the run's days (those of
    the weather batch and of ``energy``) and to pending days; ``False`` re-reads whole
    tables (same result).
    ``register_tables`` exposes the tables as ``raw.*``, ``staging.*``, ``mart.*``
    in the session catalog (see ``hourcast.plans.catalog``).
    ``as_of`` (a date) keeps only the last ``n_days`` complete UTC days before it,
    so a partial current day is never loaded.
    """
    configure(spark)
    layout = Layout(warehouse)
    if sum(x is not None for x in (landing, csv, weather)) != 1:
        raise ValueError("give exactly one of landing=, csv=, weather=")
    folder = f"{layout.warehouse.rstrip('/')}/batches/{uuid.uuid4().hex}"
    watch = None
    try:
        if landing is not None:
            weather = weather_from_landing(spark, landing)
        elif csv is not None:
            # the ingest gate observes the text rows while the batch is written
            watch = Watch(read_processed_csv(spark, csv), [ingest_gate()])
            weather = parse_weather_rows(watch.df)
        weather = weather.select("time", "region", "temperature_2m")   # the raw table's shape
        if as_of is not None:
            weather = weather.filter(within_complete_days(utc_day("time"), as_of, n_days))
        # Batches are read several times (days and duplicates, then the upsert): they are
        # written once, so parsing or joins behind them run once.
        weather = _written(spark, weather, f"{folder}/weather")
        if watch is not None:
            watch.check()
            require_rows(weather)
        weather_days = checked_days(weather, "weather")
        energy_days = weather_days
        if energy is not None:
            energy = _written(spark, energy.select("ts", "region", "load_mw"), f"{folder}/energy")
            energy_days = checked_days(energy, "energy", "ts")
        # before anything is loaded: a run that stops leaves its days to the next one
        todo = sorted({str(d) for d in [*weather_days, *energy_days]} | set(pending_days(spark, layout)))
        set_pending(spark, layout, todo)
        load_weather(spark, layout, weather, weather_days)
        if energy is not None:
            load_energy(spark, layout, energy, energy_days)
        else:
            model_energy(spark, layout, jitter, weather_days if incremental else None)
    finally:
        sink.delete_path(spark, folder)
    days = todo if incremental else None
    stage(spark, layout, days, days, weather_days if energy is None else None)
    gate_staging(spark, layout, expected_rows, days)
    build_marts(spark, layout, days)
    test_marts(spark, layout, days)
    set_pending(spark, layout, [])
    if register_tables:
        from hourcast.plans.catalog import register
        register(spark, layout)
    return RunResult(layout, quality_reports(spark, layout, expected_rows))


def _written(spark: SparkSession, batch: DataFrame, folder: str) -> DataFrame:
    batch.write.parquet(folder)
    return spark.read.parquet(folder)
