"""Landed JSON documents: scan, structural checks, flatten to hourly rows.

A document holds a provenance envelope (``_meta``) and one entry per region with
two parallel arrays ``payload.hourly.time[]`` / ``payload.hourly.temperature_2m[]``.
A landing directory holds many documents; each document is one row, so the scan
and the flatten parallelise over files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.functions.time import parse_timestamp
from hourcast.schemas import LANDING_DOCUMENT, META


class DocumentError(ValueError):
    """A landed document violates the structural contract."""


def read_documents(spark: SparkSession, path: str, with_file: bool = True,
                   multi_line: bool = True) -> DataFrame:
    """Scan JSON documents with the declared schema (no inference).

    ``multi_line=True``: one (pretty-printed) document per file, as landed by an
    extract; ``False``: JSON Lines, one document per line (as Spark writes them).
    """
    df = spark.read.schema(LANDING_DOCUMENT).option("multiLine", multi_line).json(path)
    if with_file:
        df = df.withColumn("source_file", F.col("_metadata.file_path"))
    return df


def _entries(docs: DataFrame) -> DataFrame:
    """One row per region entry (one with NULL ``r`` for a document without any)
    with ``problem``, its first structural fault or NULL.

    Checked in this order: no ``regions``; an entry without ``region``; a missing
    array; arrays of unequal length.  ``arrays_zip`` pads silently, so lengths are
    compared before anything is flattened.
    """
    doc = F.coalesce(F.col("source_file"), F.lit("")) if "source_file" in docs.columns \
        else F.lit("")
    e = docs.select(doc.alias("doc"), F.explode_outer("regions").alias("r"))
    region = F.col("r.region")
    times, temps = F.col("r.payload.hourly.time"), F.col("r.payload.hourly.temperature_2m")
    problem = (F.when(F.col("r").isNull(), F.lit("document without regions"))
               .when(region.isNull() | (region == ""), F.lit("entry without region"))
               .when(times.isNull() | temps.isNull(), F.lit("entry without hourly arrays"))
               .when(F.size(times) != F.size(temps),
                     F.format_string("%d times for %d temperatures",
                                     F.size(times), F.size(temps))))
    return e.select("doc", region.alias("region"), problem.alias("problem"),
                    times.alias("times"), temps.alias("temps"))


def document_violations(docs: DataFrame) -> DataFrame:
    """One row per structural violation: (doc, region, problem)."""
    return (_entries(docs).filter(F.col("problem").isNotNull())
            .select("doc", "region", "problem"))


def document_profile(docs: DataFrame, lo: float = -50.0, hi: float = 60.0) -> DataFrame:
    """One-row summary of structural problems and row-level content, one pass.

    Works at region-entry level: the parallel arrays are inspected with array
    functions (``size``/``filter``) instead of being exploded, so the check costs
    one scan of the documents.  Columns: ``problem``/``problem_region``/
    ``problem_doc`` (one structural violation or NULL) and the counts of
    :func:`hourcast.operators.quality.ingest_profile`.
    """
    n = lambda arr, pred: F.coalesce(F.size(F.filter(arr, pred)), F.lit(0))
    rows = _entries(docs).select(
        "problem", "region", "doc", F.coalesce(F.size("times"), F.lit(0)).alias("n"),
        n("times", lambda x: x.isNull() | (x == "")).alias("bt"),
        n("temps", lambda x: x.isNull()).alias("nt"),
        n("temps", lambda x: (x < F.lit(lo)) | (x > F.lit(hi)) | F.isnan(x)).alias("bad"))
    first = F.min_by(F.struct("problem", "region", "doc"),
                     F.when(F.col("problem").isNotNull(), F.struct("doc", "region")))
    return rows.agg(first.alias("p"), F.sum("n").alias("n_rows"), F.sum("bt").alias("no_time"),
                    F.sum("nt").alias("no_value"), F.lit(0).cast("bigint").alias("not_numeric"),
                    F.sum("bad").alias("outside")) \
        .select(F.col("p.problem").alias("problem"), F.col("p.region").alias("problem_region"),
                F.col("p.doc").alias("problem_doc"), "n_rows", "no_time", "no_value",
                "not_numeric", "outside")


def raise_document(r) -> None:
    """Raise for a structural violation in a row of :func:`document_profile`."""
    if r is not None and r["problem"] is not None:
        raise DocumentError(f"{r['problem']} (region {r['problem_region']}, "
                            f"file {r['problem_doc'] or 'unknown'})")


def flatten(docs: DataFrame, with_meta: bool = False) -> DataFrame:
    """Documents -> (region, time, temperature_2m) rows, ``time`` kept as text.

    ``explode`` the regions, then ``inline(arrays_zip(...))`` pairs the parallel
    arrays element by element, all inside the JVM.
    """
    keep = ["_meta"] if with_meta and "_meta" in docs.columns else []
    r = docs.select(*keep, F.explode("regions").alias("r"))
    z = r.select(*keep, F.col("r.region").alias("region"),
                 F.arrays_zip(F.col("r.payload.hourly.time").alias("time"),
                              F.col("r.payload.hourly.temperature_2m").alias("temperature_2m")
                              ).alias("z"))
    out = z.select(*keep, "region", F.inline("z"))
    if with_meta:
        out = out.select("region", "time", "temperature_2m",
                         *[F.col(f"_meta.{f}").alias(f"meta_{f}")
                           for f in META.fieldNames()])
    return out


def typed_hourly(flat: DataFrame, lenient: bool = False) -> DataFrame:
    """Cast the flattened text time to TIMESTAMP (UTC session zone)."""
    return flat.withColumn("time", parse_timestamp("time", lenient=lenient))


def build_documents(weather: DataFrame, regions_table: DataFrame | None = None,
                    source: str = "archive", timezone: str = "UTC",
                    doc_buckets: int | None = None) -> DataFrame:
    """Hourly weather -> landed documents (the extract's shape).

    Each document carries regions for one UTC day with their hourly values in
    time order.  ``doc_buckets=None`` writes one document per (day, region), so
    a group never exceeds one series-day; ``doc_buckets=n`` hashes the regions
    of a day into n multi-region documents (use when the region set is known to
    be small, as for a fetch of a few regions).  History length never enters a
    group.
    """
    w = weather.select(F.col("ts"), "region", "temperature_2m",
                       F.to_date("ts").alias("day"),
                       F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("time"))
    per_region = (w.groupBy("day", "region")
                  .agg(F.array_sort(F.collect_list(F.struct("time", "temperature_2m")))
                       .alias("pts")))
    if regions_table is not None:
        per_region = per_region.join(regions_table, "region", "left")
    else:
        per_region = per_region.withColumn("latitude", F.lit(None).cast("double")) \
            .withColumn("longitude", F.lit(None).cast("double"))
    entry = F.struct(
        F.col("region"), F.col("latitude"), F.col("longitude"),
        F.struct(F.struct(F.col("pts.time").alias("time"),
                          F.col("pts.temperature_2m").alias("temperature_2m")
                          ).alias("hourly")).alias("payload"))
    meta = F.struct(F.lit(source).alias("source"), F.lit(timezone).alias("timezone"),
                    F.col("day").cast("string").alias("start_date"),
                    F.col("day").cast("string").alias("end_date"),
                    F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")
                    .alias("fetched_at_utc"),
                    F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")
                    .alias("fetched_at_local"))
    if doc_buckets is None:
        doc = F.xxhash64("region")
    else:
        doc = F.pmod(F.xxhash64("region"), F.lit(doc_buckets)) if doc_buckets > 1 else F.lit(0)
    return (per_region.withColumn("doc_bucket", doc).groupBy("day", "doc_bucket")
            .agg(F.array_sort(F.collect_list(entry)).alias("regions"))
            .select(meta.alias("_meta"), "regions", "day", "doc_bucket"))
