import pytest

from hourcast.sources import driver_tables as dt
from tests.conftest import SF
from tests.helpers import collect_sorted


@pytest.mark.parametrize("mode", ["regions", "users"])
def test_one_scan_equals_per_series(spark, mode):
    ev = dt.events(spark, SF)
    e, w, _ = dt.hourly_both(ev, mode)
    assert collect_sorted(e.select("ts", "region", "day", "load_mw")) == \
        collect_sorted(dt.hourly_energy(ev, mode).select("ts", "region", "day", "load_mw"))
    assert collect_sorted(w.select("ts", "region", "day", "temperature_2m")) == \
        collect_sorted(dt.hourly_weather(ev, mode).select("ts", "region", "day",
                                                          "temperature_2m"))


def test_users_without_weather_have_null_temperatures_in_the_mart(spark):
    from hourcast.plans.registry import QUERIES
    mart = QUERIES["mart_energy_weather_daily_by_user"](spark, SF)
    assert 0 < mart.filter("avg_temp_c IS NULL").count() < mart.count()
