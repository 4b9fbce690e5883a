import pytest

from hourcast.operators import quality as Q
from hourcast.plans import marts as M
from tests.helpers import energy_df, weather_df


def test_distinct_struct_counts_null_parts(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3)], "a int, b int")
    r = Q.grain_report(df, ["a", "b"]).collect()[0]
    assert (r.total_rows, r.distinct_grain, r.duplicate_rows) == (3, 2, 1)


def test_range_counts_nan_not_null(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (10.0,), (-41.0,)], "t double")
    assert Q.range_report(df, "t", -40, 45, "bad").collect()[0].bad == 2


def test_gates(spark):
    w = weather_df(spark, [("2024-01-01 00:00:00", "R", 50.0)])
    with pytest.raises(Q.GateFailed):
        Q.gate_range(w)
    e = energy_df(spark, [("2024-01-01 00:00:00", "R", 1.0), ("2024-01-01 00:00:00", "R", 2.0)])
    with pytest.raises(Q.GateFailed):
        Q.gate_unique(e)
    with pytest.raises(Q.GateFailed):
        Q.gate_rowcount(e, 2160)
    Q.gate_rowcount(e, 2)


def test_spike_report_threshold_and_order(spark):
    e = energy_df(spark, [("2024-01-01 00:00:00", "R", 0.0), ("2024-01-01 01:00:00", "R", 500.0),
                          ("2024-01-01 02:00:00", "R", 0.0), ("2024-01-01 03:00:00", "R", 100.0)])
    r = Q.spike_report(e, threshold=400, top=20).collect()
    assert [x.delta_mw for x in r] == [500.0, -500.0]


def test_missing_dim_counts_row_once(spark):
    e = energy_df(spark, [("2024-01-01 00:00:00", "R", 1.0), ("2024-01-02 00:00:00", "X", 1.0)])
    fact = M.fact_energy_daily(e)
    dd = spark.createDataFrame([("2024-01-01",)], "d string").selectExpr("to_date(d) AS day")
    dr = spark.createDataFrame([("R",)], "region string")
    assert Q.missing_dim_report(fact, {"day": dd, "region": dr}).collect()[0][0] == 1


def test_value_order_and_reconcile(spark):
    e = energy_df(spark, [("2024-01-01 00:00:00", "R", 1.0), ("2024-01-01 01:00:00", "R", 3.0)])
    fact = M.fact_energy_daily(e)
    assert Q.value_order_report(fact).collect()[0].bad_rows == 0
    r = Q.reconcile_counts(fact, e).collect()[0]
    assert r.n_hours == 2 and r.hourly_rows == 2
    assert Q.reconcile_counts(fact, e, mismatches_only=True).count() == 0


def test_model_tests_and_gate(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "a", -1.0), (None, "b", None)],
                               "day_utc int, region string, avg_load_mw double")
    tests = [("not_null", "day_utc"), ("not_null", "avg_load_mw"),
             ("unique_combination", ["day_utc", "region"]), ("unique", "day_utc"),
             ("expression_is_true", "avg_load_mw > 0")]
    got = {r.test: r.failures for r in Q.model_test_failures(df, tests).collect()}
    assert got == {"not_null:day_utc": 1, "not_null:avg_load_mw": 1,
                   "unique_combination:day_utc,region": 1, "unique:day_utc": 1,
                   "expression_is_true:avg_load_mw > 0": 1}  # NULL passes the expression
    with pytest.raises(Q.GateFailed):
        Q.gate_tests(df, tests)


def test_table_profile_one_pass(spark):
    e = energy_df(spark, [("2024-01-01 00:00:00", "R", 1.0), ("2024-01-01 00:00:00", "R", None),
                          ("2024-01-01 01:00:00", "R", 6000.0)])
    r = Q.table_profile(e, ["ts", "region"], ["ts", "region", "load_mw"],
                        {"load_mw": (0, 5000)}).collect()[0]
    assert (r.total_rows, r.distinct_grain, r.null_violations, r.bad_load_mw_rows,
            r.duplicate_rows) == (3, 2, 1, 1, 1)
