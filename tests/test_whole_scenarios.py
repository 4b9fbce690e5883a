"""The pipeline's scenarios cover every day, and the CSV layouts every row."""

from pyspark.sql import functions as F

from hourcast.plans.registry import QUERIES, raw_pair
from tests.conftest import SF


def test_scenarios_cover_every_day_and_region(spark):
    raw_e, raw_w = raw_pair(spark, SF)
    days = lambda df, column: {tuple(r) for r in df.select(
        F.col(column).cast("date"), "region").distinct().collect()}
    for name, want in (("measured", days(raw_e, "ts")), ("half_day", days(raw_e, "ts")),
                       ("repaired", days(raw_w, "time"))):
        assert days(QUERIES[f"daily_run_{name}_whole"](spark, SF), "day") == want, name


def test_csv_layouts_hold_every_row(spark):
    _, raw_w = raw_pair(spark, SF)
    got = QUERIES["csv_mixed_whole"](spark, SF)
    assert got.count() == raw_w.filter(~F.hour("time").isin(9, 17)).count()
