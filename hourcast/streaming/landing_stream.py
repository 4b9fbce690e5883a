"""Landing directory -> pipeline, driven by Structured Streaming.

The pipeline is a daily batch with no event-time state: late or corrected
hours are absorbed by the keyed upserts.  Streaming adds exactly one thing --
durable bookkeeping of which landed documents were already processed.  The
file source records processed files in the checkpoint, ``foreachBatch`` runs
the batch pipeline on just the new documents, and because every write is a
keyed upsert, a micro-batch replayed after a failure produces the same tables
(idempotent sink).  Several documents for the same hours in one micro-batch are a
correction: the one fetched last counts.  ``availableNow`` processes whatever has landed, then stops
-- the scheduled-daily-run shape.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from hourcast.plans import daily
from hourcast.plans.ingest import weather_from_documents
from hourcast.schemas import LANDING_DOCUMENT


def landing_stream(spark: SparkSession, landing_dir: str, max_files: int | None = None,
                   multi_line: bool = True) -> DataFrame:
    reader = spark.readStream.schema(LANDING_DOCUMENT).option("multiLine", multi_line)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(landing_dir)


def start(spark: SparkSession, landing_dir: str, warehouse: str, checkpoint: str,
          expected_rows: int | None = None, available_now: bool = True,
          processing_time: str | None = None, max_files: int | None = None,
          multi_line: bool = True) -> StreamingQuery:
    """Start the incremental pipeline; returns the running query."""
    def run_batch(docs: DataFrame, epoch_id: int) -> None:
        if docs.isEmpty():
            return
        weather = weather_from_documents(docs, check=True, latest=True)
        daily.run(docs.sparkSession, warehouse, weather=weather, expected_rows=expected_rows)

    w = landing_stream(spark, landing_dir, max_files, multi_line).writeStream \
        .foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
