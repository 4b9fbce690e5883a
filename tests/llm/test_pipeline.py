import hashlib

import public_tokenizers
import tiktoken

import corpus_pipeline
from conftest import SF
from hourcast.llm import bpe
from hourcast.llm import pipeline as P
from test_decontaminate import brute as brute_leaks
from test_simhash import brute_components, slow_fingerprint
from test_substring import brute as brute_windows


def rows(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages_in_order_and_columns(spark):
    assert corpus_pipeline.STAGES is P.STAGES and corpus_pipeline.run is P.run
    assert [n for n, _ in P.STAGES] == ["quality", "near_duplicates", "substrings", "decontamination", "bpe"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


def test_run_against_brute_force(spark):
    """All stages behind the classifier, in plain Python over its rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = rows(P.quality_stage(spark, docs, SF))
    fps = [(d, slow_fingerprint(t)) for d, t in kept.items()]
    kept = {d: kept[d] for (d, _), c in zip(fps, brute_components(fps)) if d == c}
    for d, _, gone, text in brute_windows(list(kept.items()), 35):
        if gone:
            kept[d] = text
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {d for d, *_ in brute_leaks(list(kept.items()), items)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    expected = set()
    for d, text in kept.items():
        if d not in leaks:
            ids = library.encode_ordinary(text or "")
            expected.add((d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                          hashlib.sha256((text or "").encode()).hexdigest()))
    got = [tuple(r) for r in P.run(spark, SF).collect()]
    assert len(got) == len(set(got)) and set(got) == expected and 0 < len(got) < docs.count()


def test_edge_rows_and_empty_table(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0),
                                 (2, "x " * 50_000, None, None, None)], schema)
    for df in (odd, odd.filter("false")):
        for _, stage in P.STAGES:
            stage(spark, df, SF).collect()
