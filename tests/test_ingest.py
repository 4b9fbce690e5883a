import json
import os

import pytest
from pyspark.sql import functions as F

from hourcast.operators.quality import GateFailed, gate_ingest
from hourcast.plans.ingest import weather_from_csv, weather_from_landing
from hourcast.sources import csv as csv_src
from hourcast.sources import landing


def _doc(regions, meta=True):
    d = {"regions": regions}
    if meta:
        d["_meta"] = {"source": "archive", "timezone": "UTC", "start_date": "2024-01-01",
                      "end_date": "2024-01-01", "fetched_at_utc": "2024-01-02T00:00:00+00:00",
                      "fetched_at_local": "2024-01-02T00:00:00+00:00"}
    return d


def _region(name, times, temps):
    hourly = {}
    if times is not None:
        hourly["time"] = times
    if temps is not None:
        hourly["temperature_2m"] = temps
    return {"region": name, "latitude": 1.0, "longitude": 2.0, "payload": {"hourly": hourly}}


def _write(dirpath, docs):
    os.makedirs(dirpath, exist_ok=True)
    for i, d in enumerate(docs):
        with open(os.path.join(dirpath, f"doc{i}.json"), "w") as f:
            json.dump(d, f, indent=2)   # pretty-printed, as landed
    return dirpath


def test_flatten_zips_parallel_arrays(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "ok"), [
        _doc([_region("DE-NW", ["2024-01-01T00:00", "2024-01-01T01:00"], [1.5, None]),
              _region("DE-BY", ["2024-01-01T00:00"], [-2.0])])])
    docs = landing.read_documents(spark, p)
    landing.raise_document(landing.document_profile(docs).first())
    rows = sorted(tuple(r) for r in landing.flatten(docs).collect())
    assert rows == [("DE-BY", "2024-01-01T00:00", -2.0), ("DE-NW", "2024-01-01T00:00", 1.5),
                    ("DE-NW", "2024-01-01T01:00", None)]
    with pytest.raises(GateFailed, match="have no temperature"):
        weather_from_landing(spark, p)                   # JSON null temperature fails the gate
    typed = weather_from_landing(spark, p, validate=False)
    assert typed.schema["time"].dataType.simpleString() == "timestamp"
    assert typed.filter(F.col("time") == F.to_timestamp(F.lit("2024-01-01 01:00:00"))).count() == 1
    meta = landing.flatten(docs, with_meta=True).select("meta_source", "meta_fetched_at_local").distinct().collect()
    assert tuple(meta[0]) == ("archive", "2024-01-02T00:00:00+00:00")


@pytest.mark.parametrize("doc,problem", [
    (_doc([]), "document without regions"),
    ({"_meta": None}, "document without regions"),
    (_doc([_region(None, ["t"], [1.0])]), "entry without region"),
    (_doc([_region("R", None, [1.0])]), "entry without hourly arrays"),
    (_doc([_region("R", ["a", "b"], [1.0])]), "2 times for 1 temperatures"),
])
def test_document_checks(spark, tmp_dir, doc, problem):
    p = _write(os.path.join(tmp_dir, "bad"), [doc])
    docs = landing.read_documents(spark, p)
    with pytest.raises(landing.DocumentError, match=problem):
        landing.raise_document(landing.document_profile(docs).first())


def test_build_documents_roundtrip(spark, tmp_dir):
    from tests.helpers import weather_df
    w = weather_df(spark, [("2024-01-01 00:00:00", "A", 1.0), ("2024-01-01 01:00:00", "A", 2.0),
                           ("2024-01-01 00:00:00", "B", 3.0), ("2024-01-02 00:00:00", "A", 4.0)])
    docs = landing.build_documents(w, doc_buckets=1)
    assert docs.count() == 2
    assert landing.build_documents(w).count() == 3      # default: one per (day, region)
    out = os.path.join(tmp_dir, "landing")
    docs.select("_meta", "regions").write.json(out)
    back = weather_from_landing(spark, out, multi_line=False)
    got = sorted((str(r.time), r.region, r.temperature_2m) for r in back.collect())
    assert got == [("2024-01-01 00:00:00", "A", 1.0), ("2024-01-01 00:00:00", "B", 3.0),
                   ("2024-01-01 01:00:00", "A", 2.0), ("2024-01-02 00:00:00", "A", 4.0)]


def _csv(path, header, rows):
    with open(path, "w") as f:
        f.write(header + "\n")
        for r in rows:
            f.write(",".join(r) + "\n")
    return path


def test_csv_without_region_uses_default(spark, tmp_dir):
    p = _csv(os.path.join(tmp_dir, "a.csv"), "time,temperature_2m",
             [("2024-01-01T00:00", "1.0"), ("", "2.0"), ("2024-01-01T02:00", "")])
    df = csv_src.parse_weather_rows(csv_src.read_processed_csv(spark, p))
    r = df.collect()
    assert len(r) == 1 and r[0].region == "DE" and r[0].temperature_2m == 1.0


def test_csv_columns_by_name_any_order(spark, tmp_dir):
    p = _csv(os.path.join(tmp_dir, "o.csv"), "temperature_2m,time,region",
             [("3.5", "2024-01-01T00:00", "DE-BE")])
    r = csv_src.parse_weather_rows(csv_src.read_processed_csv(spark, p)).collect()[0]
    assert (r.region, r.temperature_2m, str(r.time)) == ("DE-BE", 3.5, "2024-01-01 00:00:00")


def test_csv_blank_region_trimmed_default(spark, tmp_dir):
    p = _csv(os.path.join(tmp_dir, "b.csv"), "region,time,temperature_2m",
             [("  ", "2024-01-01T00:00", "1.0"), (" DE-BY ", "2024-01-01T00:00", "2.0")])
    df = csv_src.parse_weather_rows(csv_src.read_processed_csv(spark, p))
    assert sorted(r.region for r in df.collect()) == ["DE", "DE-BY"]


def test_ingest_gate(spark, tmp_dir):
    rows = [("R", f"2024-01-{1 + i // 24:02d}T{i % 24:02d}:00", "1.0") for i in range(250)]
    ok = _csv(os.path.join(tmp_dir, "ok.csv"), "region,time,temperature_2m", rows)
    assert weather_from_csv(spark, ok).count() == 250
    few = _csv(os.path.join(tmp_dir, "few.csv"), "region,time,temperature_2m", rows[:10])
    with pytest.raises(GateFailed, match="only 10 weather rows"):
        weather_from_csv(spark, few)
    for bad, msg in [("", "have no temperature"), ("abc", "are not numbers"), ("61", "are outside"),
                     ("NaN", "are outside")]:
        p = _csv(os.path.join(tmp_dir, f"bad{msg[:3]}.csv"), "region,time,temperature_2m",
                 rows + [("R", "2024-02-01T00:00", bad)])
        with pytest.raises(GateFailed, match=msg):
            gate_ingest(csv_src.read_processed_csv(spark, p))


def test_empty_input_error(spark, tmp_dir):
    p = _csv(os.path.join(tmp_dir, "e.csv"), "region,time,temperature_2m", [("R", "", "1")])
    with pytest.raises(csv_src.EmptyInputError):
        csv_src.require_rows(csv_src.parse_weather_rows(csv_src.read_processed_csv(spark, p)))


def test_complete_days_window(spark):
    from hourcast.sources.tables import complete_days
    df = spark.createDataFrame([(d,) for d in ("2024-01-01", "2024-01-02", "2024-01-30",
                                               "2024-01-31")], "d string") \
        .selectExpr("to_date(d) AS day")
    got = [str(r.day) for r in complete_days(df, "2024-01-31", 30).orderBy("day").collect()]
    assert got == ["2024-01-01", "2024-01-02", "2024-01-30"]


def test_document_violations_lists_every_problem(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "many"), [
        _doc([]),
        _doc([_region("A", ["t1", "t2"], [1.0]), _region("", ["t"], [1.0]),
              _region("B", ["t"], [2.0])])])
    got = sorted((r.region or "", r.problem)
                 for r in landing.document_violations(landing.read_documents(spark, p)).collect())
    assert got == [("", "document without regions"), ("", "entry without region"),
                   ("A", "2 times for 1 temperatures")]


def test_documents_carry_region_coordinates(spark):
    from hourcast.sources.tables import regions_table
    from tests.helpers import weather_df
    w = weather_df(spark, [("2024-01-01 00:00:00", "DE-BY", 1.0)])
    docs = landing.build_documents(w, regions_table=regions_table(spark))
    r = docs.select(F.explode("regions").alias("r")).select("r.region", "r.latitude").first()
    assert r.region == "DE-BY" and r.latitude == 48.1351


def test_csv_files_of_one_folder_are_read_by_their_own_headers(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "mixed")
    os.makedirs(folder)
    _csv(os.path.join(folder, "a.csv"), "region,time,temperature_2m", [("DE-BY", "2024-01-01T00:00", "1.0")])
    _csv(os.path.join(folder, "b.csv"), "time,region,temperature_2m", [("2024-01-01T01:00", "DE-NW", "2.0")])
    _csv(os.path.join(folder, "c.csv"), "temperature_2m,other,time", [("3.0", "x", "2024-01-01T02:00")])
    rows = csv_src.parse_weather_rows(csv_src.read_processed_csv(spark, folder)).orderBy("time").collect()
    assert [(r.region, r.time.hour, r.temperature_2m) for r in rows] == [
        ("DE-BY", 0, 1.0), ("DE-NW", 1, 2.0), ("DE", 2, 3.0)]


def test_csv_with_a_misfit_header_raises(spark, tmp_dir):
    p = _csv(os.path.join(tmp_dir, "misfit.csv"), "region,when,temperature_2m", [("R", "2024-01-01T00:00", "1")])
    with pytest.raises(Exception, match="no header with time"):
        csv_src.read_processed_csv(spark, p).collect()
    with pytest.raises(Exception):
        csv_src.read_processed_csv(spark, p, has_region=True).collect()


def test_a_later_document_corrects_an_earlier_one(spark, tmp_dir):
    from hourcast.plans.ingest import weather_from_documents
    first, second = (_doc([_region("R", ["2024-01-01T00:00"], [t])]) for t in (1.0, 2.0))
    second["_meta"] = dict(second["_meta"], fetched_at_utc="2024-01-03T00:00:00+00:00")
    p = _write(os.path.join(tmp_dir, "corrected"), [second, first])
    got = weather_from_documents(landing.read_documents(spark, p), latest=True).collect()
    assert [r.temperature_2m for r in got] == [2.0]


def test_read_table_by_catalog_name(spark, tmp_dir):
    from hourcast.sources.tables import read_table
    p = os.path.join(tmp_dir, "named")
    spark.range(3).write.parquet(p)
    spark.sql("CREATE DATABASE IF NOT EXISTS hc_test")
    spark.sql(f"CREATE TABLE IF NOT EXISTS hc_test.named USING parquet LOCATION '{p}'")
    assert read_table(spark, "hc_test.named").count() == 3
    assert read_table(spark, p).count() == 3
