"""Plan-shape guards: everything stays JVM-side, top-k and rank filters keep
their limit operators, predicates reach the parquet scan."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from hourcast.plans.queries import QUERIES
from tests.conftest import SF

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                "MapInPandas", "FlatMapCoGroupsInPandas", "PythonUDF", "MapInArrow")


def _plan(spark, name):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        E.queries()[name](spark, SF).explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_plans(spark, name):
    plan = _plan(spark, name)
    assert not any(n in plan for n in PYTHON_NODES), name


@pytest.mark.parametrize("name,node", [("top3_hours", "WindowGroupLimit"),
                                       ("peak_hour_by_region", "WindowGroupLimit"),
                                       ("hourly_join", "TakeOrderedAndProject"),
                                       ("load_spikes", "TakeOrderedAndProject")])
def test_limit_operators(spark, name, node):
    assert node in _plan(spark, name)


@pytest.mark.parametrize("name", ["complete_days_energy", "upsert_energy", "insert_if_absent"])
def test_predicates_reach_the_scan(spark, name):
    plan = _plan(spark, name)
    assert "PushedFilters: [" in plan and "PushedFilters: []" not in plan.split("Scan")[1][:2000]


def test_day_filter_reaches_both_sides_of_the_hourly_join(spark):
    from pyspark.sql import functions as F

    from hourcast.operators.joins import hourly_pair
    from hourcast.plans.registry import pair
    e, w = pair(spark, SF)
    j = hourly_pair(e.filter(F.col("day") == F.to_date(F.lit("2024-01-05"))), w)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        j.explain("formatted")
    pushed = [ln for ln in buf.getvalue().splitlines() if "PushedFilters" in ln]
    assert len(pushed) == 2 and all("EqualTo(day,2024-01-05)" in ln for ln in pushed)


@pytest.mark.parametrize("name", ["fact_daily", "lag_delta", "temp_buckets", "grain_energy",
                                  "weekend_effect", "top3_hours"])
def test_executed_plan_runs_in_whole_stage_codegen(spark, name):
    import re
    df = E.queries()[name](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert len(set(re.findall(r"\*\((\d+)\)", plan))) >= 1, plan
