"""Landed JSON / processed CSV -> typed hourly weather rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.operators.quality import gate_ingest, raise_ingest
from hourcast.operators.upsert import dedupe_batch
from hourcast.sources import csv as csv_src
from hourcast.sources import landing


def weather_from_documents(docs: DataFrame, check: bool = True, lenient_time: bool = False,
                           validate: bool | None = None, min_rows: int = 1,
                           lo: float = -50, hi: float = 60, latest: bool = False) -> DataFrame:
    """Documents -> (time, region, temperature_2m).

    ``latest``: of several documents with the same (time, region) the one fetched
    last counts (``_meta.fetched_at_utc``; equal times: the higher temperature).

    ``check``: structural document checks.  ``validate`` (defaults to
    ``check``): the pre-load gate on the rows -- at least ``min_rows``, time and
    temperature present (a JSON null temperature fails, as its empty CSV cell
    would), temperature within [lo, hi] (NaN fails).  Both are answered by one
    aggregate pass over the documents before any write.
    """
    validate = check if validate is None else validate
    if check or validate:
        r = landing.document_profile(docs, lo, hi).first()
        if check:
            landing.raise_document(r)
        if validate:
            raise_ingest(r, min_rows, lo, hi)
    rows = landing.typed_hourly(landing.flatten(docs, with_meta=latest), lenient=lenient_time)
    if latest:
        fetched = F.try_to_timestamp(F.col("meta_fetched_at_utc"))
        rows = dedupe_batch(rows, ["time", "region"], order=[fetched, "temperature_2m"])
    return rows.select("time", "region", "temperature_2m")


def weather_from_landing(spark: SparkSession, path: str, check: bool = True,
                         multi_line: bool = True, **gate) -> DataFrame:
    docs = landing.read_documents(spark, path, multi_line=multi_line)
    return weather_from_documents(docs, check=check, **gate)


def weather_from_text(text: DataFrame, default_region: str = "DE", validate: bool = True,
                      min_rows: int = 200, lo: float = -50, hi: float = 60) -> DataFrame:
    """Processed-CSV text rows -> typed rows.  ``validate`` runs the strict
    pre-load gate (row count, presence, range) on the text; the parse itself is
    lenient about incomplete rows (dropped) and blank regions (default)."""
    if validate:
        gate_ingest(text, min_rows=min_rows, lo=lo, hi=hi)
    return csv_src.require_rows(csv_src.parse_weather_rows(text, default_region))


def weather_from_csv(spark: SparkSession, path: str, default_region: str = "DE",
                     validate: bool = True, min_rows: int = 200, lo: float = -50,
                     hi: float = 60) -> DataFrame:
    """Processed CSV -> typed rows (see :func:`weather_from_text`)."""
    return weather_from_text(csv_src.read_processed_csv(spark, path), default_region,
                             validate, min_rows, lo, hi)
