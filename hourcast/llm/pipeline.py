"""The stages of the corpus pipeline: quality, near duplicates, repeated passages,
benchmark leaks, token ids.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage before
it kept; all but the last return the columns of ``docs`` as they came, extra ones included.
Nulls, empty and very long texts, ties, repeated rows, empty tables and extra columns have
the results that the operator of the stage states; what follows from them is said here.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.llm import bpe, decontaminate, quality, simhash, substring
from hourcast.llm._frames import scratch
from hourcast.llm.queries import bpe_digests


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject (score of 0.7 or more).

    A null or empty text is scored like any other, and so usually rejected; equal texts
    have equal scores, so repeated rows are kept or rejected together; without documents
    or labels to learn from nothing is left.
    """
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    trees = quality.fit(spark, docs, labels, quality.id_remainder("doc_id", 4) != 2)
    scored = quality.score(spark, docs, trees)
    return scored.filter(F.col("score") >= quality.THRESHOLD).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, that of the smallest id; documents
    without an id come last, and of rows with equal ids one stays.  All texts without a
    word are one component."""
    return simhash.keep_one(spark, docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of repeated windows; texts that repeat nothing, null
    among them, are unchanged.  Repeated rows repeat each other and lose their windows."""
    cut = substring.remove_repeats(spark, docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    n_chars = F.when(F.col("n_removed") > 0, F.char_length("kept_text")).otherwise(F.col("n_chars"))
    return (cut.withColumns({"text": text, "n_chars": n_chars.cast(docs.schema["n_chars"].dataType)})
            .select(*docs.columns))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item; a text without words contains none, and
    an item without words is in no document.  Repeated rows go or stay together."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontaminate.drop_contaminated(spark, docs, items)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text and what they decode to, as digests, one row per row; a
    null text has no ids."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe_digests(bpe.roundtrip(spark, docs.select("doc_id", "text"), path))


STAGES = [("quality", quality_stage), ("near_duplicates", near_duplicate_stage),
          ("substrings", substring_stage), ("decontamination", decontamination_stage), ("bpe", bpe_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from all ``documents`` of ``sf_dir``.

    Each result is written to the folder that all executors share and read again, so a
    lost executor costs one stage at most.
    """
    folder = scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
