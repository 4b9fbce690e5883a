import os

import pytest
from pyspark.sql import functions as F

from hourcast.operators.upsert import (DuplicateKeyError, dedupe_batch, insert_if_absent,
                                       merge_columns, merge_replace)
from hourcast.sinks import tables as sink
from tests.helpers import collect_sorted, energy_df

KEYS = ["ts", "region"]


def test_merge_replace_updates_inserts_never_deletes(spark):
    t = energy_df(spark, [("2024-01-01 00:00:00", "R", 1.0), ("2024-01-01 01:00:00", "R", 2.0)])
    b = energy_df(spark, [("2024-01-01 01:00:00", "R", 9.0), ("2024-01-02 00:00:00", "R", 3.0)])
    got = [x[2] for x in collect_sorted(merge_replace(t, b, KEYS), "ts")]
    assert got == [1.0, 9.0, 3.0]


def test_duplicate_key_policy(spark):
    b = spark.createDataFrame([("k", 1, 10.0), ("k", 2, 20.0), ("j", 1, 5.0)],
                              "key string, seq int, v double")
    with pytest.raises(DuplicateKeyError):
        dedupe_batch(b, ["key"])
    got = collect_sorted(dedupe_batch(b, ["key"], order=["seq"]), "key")
    assert got == [("j", 1, 5.0), ("k", 2, 20.0)]


def test_merge_columns_preserves_created_at_and_null_update(spark):
    t = spark.createDataFrame([("a", 1.0, "c0"), ("b", 2.0, "c0")], "k string, v double, created string")
    b = spark.createDataFrame([("b", None), ("c", 3.0)], "k string, v double")
    out = merge_columns(t, b, ["k"], update=["v"], preserve=["created"],
                        defaults={"created": F.lit("c1")})
    assert collect_sorted(out, "k") == [("a", 1.0, "c0"), ("b", None, "c0"), ("c", 3.0, "c1")]


def test_insert_if_absent(spark):
    t = spark.createDataFrame([(1,), (2,)], "day int")
    b = spark.createDataFrame([(2,), (3,), (3,)], "day int")
    assert collect_sorted(insert_if_absent(t, b, ["day"]), "day") == [(1,), (2,), (3,)]


def _table(spark, path):
    return collect_sorted(sink.read(spark, path).select("ts", "region", "load_mw"), "ts", "region")


def _dir_of(spark, path, day):
    m = sink.manifest(spark, path)
    return [d for d in m.dirs if m.value_of(d) == day]


def test_table_upsert_touches_only_batch_days_and_is_idempotent(spark, tmp_dir):
    path = os.path.join(tmp_dir, "energy")
    first = energy_df(spark, [("2024-01-01 00:00:00", "R", 1.0), ("2024-01-02 00:00:00", "R", 2.0),
                              ("2024-01-03 00:00:00", "R", 3.0)])
    sink.upsert(spark, first, path, KEYS)
    before = _dir_of(spark, path, "2024-01-01")
    batch = energy_df(spark, [("2024-01-02 00:00:00", "R", 20.0), ("2024-01-02 01:00:00", "R", 21.0)])
    sink.upsert(spark, batch, path, KEYS)
    once = _table(spark, path)
    assert [x[2] for x in once] == [1.0, 20.0, 21.0, 3.0]
    assert _dir_of(spark, path, "2024-01-01") == before          # untouched partition not rewritten
    sink.upsert(spark, batch, path, KEYS)               # re-applied batch
    assert _table(spark, path) == once


def test_table_upsert_matches_dict_model(spark, tmp_dir):
    import random
    rnd = random.Random(5)
    path = os.path.join(tmp_dir, "model")
    model = {}
    for _ in range(4):
        rows = {}
        for _ in range(15):
            h = rnd.randint(0, 71)
            key = (f"2024-01-{1 + h // 24:02d} {h % 24:02d}:00:00", rnd.choice("AB"))
            rows[key] = float(rnd.randint(0, 99))
        batch = energy_df(spark, [(k[0], k[1], v) for k, v in rows.items()])
        sink.upsert(spark, batch, path, KEYS)
        model.update(rows)
    got = {(str(r[0]), r[1]): r[2] for r in _table(spark, path)}
    assert got == {(k[0], k[1]): v for k, v in model.items()}


def test_insert_new_appends_only_absent(spark, tmp_dir):
    path = os.path.join(tmp_dir, "dim")
    sink.insert_new(spark, spark.createDataFrame([(1,), (2,)], "day int"), path, ["day"])
    sink.insert_new(spark, spark.createDataFrame([(2,), (3,)], "day int"), path, ["day"])
    sink.insert_new(spark, spark.createDataFrame([(2,), (3,)], "day int"), path, ["day"])
    assert collect_sorted(sink.read(spark, path), "day") == [(1,), (2,), (3,)]


def test_write_csv_and_ensure_table(spark, tmp_dir):
    from hourcast.schemas import STAGING_ENERGY
    p = os.path.join(tmp_dir, "t")
    sink.ensure_table(spark, p, STAGING_ENERGY, "day")
    assert sink.read(spark, p).count() == 0 and sink.read(spark, p).columns == STAGING_ENERGY.fieldNames()
    c = os.path.join(tmp_dir, "csv")
    sink.write_csv(spark.createDataFrame([("R", "2024-01-01T00:00", "1.5")],
                                         "region string, time string, temperature_2m string"), c)
    assert spark.read.option("header", True).csv(c).collect()[0].temperature_2m == "1.5"


def test_upsert_into_table_created_empty(spark, tmp_dir):
    from hourcast.schemas import STAGING_ENERGY
    p = os.path.join(tmp_dir, "empty")
    sink.ensure_table(spark, p, STAGING_ENERGY, "day")
    b = energy_df(spark, [("2024-01-01 00:00:00", "R", 1.0)]) \
        .withColumn("updated_at", F.current_timestamp())
    sink.upsert(spark, b, p, KEYS)
    sink.upsert(spark, b.withColumn("load_mw", F.lit(2.0)), p, KEYS)
    assert [x[2] for x in _table(spark, p)] == [2.0]


def test_last_wins_with_a_hot_key(spark):
    # one key repeated thousands of times (a replayed feed) among unique ones
    hot = spark.range(5000).select(F.lit("hot").alias("key"), F.col("id").alias("seq"),
                                   (F.col("id") * 2.0).alias("v"))
    cold = spark.range(100).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"),
                                   F.lit(0).cast("bigint").alias("seq"), F.lit(1.0).alias("v"))
    out = dedupe_batch(hot.unionByName(cold).repartition(8), ["key"], order=["seq"])
    assert out.count() == 101
    assert out.filter("key = 'hot'").first().v == 9998.0


def test_upsert_with_known_days_reads_only_those(spark, tmp_dir):
    import datetime as dt
    path = os.path.join(tmp_dir, "known")
    first = energy_df(spark, [("2024-01-01 00:00:00", "R", 1.0), ("2024-01-02 00:00:00", "R", 2.0)])
    sink.upsert(spark, first, path, KEYS, partitions=[dt.date(2024, 1, 1), dt.date(2024, 1, 2)])
    before = _dir_of(spark, path, "2024-01-01")
    # only new days: insert-only, nothing read
    new = energy_df(spark, [("2024-01-03 00:00:00", "R", 3.0)])
    sink.upsert(spark, new, path, KEYS, partitions=[dt.date(2024, 1, 3)])
    # an existing day and a new one
    mixed = energy_df(spark, [("2024-01-02 00:00:00", "R", 20.0), ("2024-01-04 00:00:00", "R", 4.0)])
    sink.upsert(spark, mixed, path, KEYS, partitions=[dt.date(2024, 1, 2), dt.date(2024, 1, 4)])
    assert [x[2] for x in _table(spark, path)] == [1.0, 20.0, 3.0, 4.0]
    assert _dir_of(spark, path, "2024-01-01") == before


def test_a_killed_write_leaves_the_table_before_or_after_never_between(spark, tmp_dir, monkeypatch):
    path = os.path.join(tmp_dir, "killed")
    first = energy_df(spark, [("2024-01-01 00:00:00", "R", 1.0), ("2024-01-02 00:00:00", "R", 2.0)])
    batch = energy_df(spark, [("2024-01-02 00:00:00", "R", 20.0), ("2024-01-03 00:00:00", "R", 30.0)])
    sink.upsert(spark, first, path, KEYS)
    real = sink.publish

    def before_switch(*a):
        raise KeyboardInterrupt

    def after_switch(*a):
        real(*a)
        raise KeyboardInterrupt

    for kill, values in ((before_switch, [1.0, 2.0]), (after_switch, [1.0, 20.0, 30.0])):
        monkeypatch.setattr(sink, "publish", kill)
        with pytest.raises(KeyboardInterrupt):
            sink.upsert(spark, batch, path, KEYS)
        monkeypatch.setattr(sink, "publish", real)
        assert [x[2] for x in _table(spark, path)] == values
    # the next write works, and vacuum removes what the dead ones left
    sink.upsert(spark, batch, path, KEYS)
    assert len(sink.vacuum(spark, path, keep=1)) >= 1
    assert [x[2] for x in _table(spark, path)] == [1.0, 20.0, 30.0]


def test_a_reader_keeps_its_version_during_a_write(spark, tmp_dir):
    path = os.path.join(tmp_dir, "versions")
    sink.upsert(spark, energy_df(spark, [("2024-01-01 00:00:00", "R", 1.0)]), path, KEYS)
    reader = sink.read(spark, path)
    sink.upsert(spark, energy_df(spark, [("2024-01-01 00:00:00", "R", 9.0)]), path, KEYS)
    assert [r.load_mw for r in reader.collect()] == [1.0]
    assert [x[2] for x in _table(spark, path)] == [9.0]


def test_duplicate_keys_fail_the_upsert_and_publish_nothing(spark, tmp_dir):
    path = os.path.join(tmp_dir, "dups")
    twice = energy_df(spark, [("2024-01-01 00:00:00", "R", 1.0), ("2024-01-01 00:00:00", "R", 2.0)])
    with pytest.raises(DuplicateKeyError):
        sink.upsert(spark, twice, path, KEYS)
    assert not sink.table_exists(spark, path)


def test_declared_schema_is_applied_and_not_null_checked(spark, tmp_dir):
    from hourcast.schemas import FACT_ENERGY_DAILY
    path = os.path.join(tmp_dir, "declared")
    row = spark.sql("""SELECT DATE '2024-01-01' AS day, 'R' AS region, 1 AS avg_load_mw, 1 AS min_load_mw,
                       1 AS max_load_mw, 24L AS n_hours, current_timestamp() AS updated_at""")
    sink.upsert(spark, row, path, ["day", "region"], schema=FACT_ENERGY_DAILY)
    got = sink.read(spark, path)
    assert dict(got.dtypes)["avg_load_mw"] == "double" and dict(got.dtypes)["n_hours"] == "int"
    with pytest.raises(Exception, match="NULL in column avg_load_mw"):
        sink.upsert(spark, row.withColumn("avg_load_mw", F.lit(None).cast("double")), path,
                    ["day", "region"], schema=FACT_ENERGY_DAILY)
    assert sink.read(spark, path).count() == 1
