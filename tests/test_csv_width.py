"""Columns are found by name however many a file has."""

import os

from hourcast.sources import csv as csv_src


def test_columns_after_the_sixteenth_are_read(spark, tmp_dir):
    extra = [f"x{i}" for i in range(20)]
    with open(os.path.join(tmp_dir, "wide.csv"), "w") as f:
        f.write(",".join(["time", "temperature_2m", *extra, "region"]) + "\n")
        f.write(",".join(["2024-01-01T00:00", "1.5", *extra, "DE-NW"]) + "\n")
    with open(os.path.join(tmp_dir, "narrow.csv"), "w") as f:
        f.write("time,temperature_2m\n2024-01-01T01:00,2.5\n")
    with open(os.path.join(tmp_dir, "late.csv"), "w") as f:
        f.write(",".join([*extra, "time", "temperature_2m"]) + "\n")
        f.write(",".join([*extra, "2024-01-01T02:00", "3.5"]) + "\n")
    rows = csv_src.parse_weather_rows(csv_src.read_processed_csv(spark, tmp_dir))
    assert sorted((r["temperature_2m"], r["region"]) for r in rows.collect()) == [
        (1.5, "DE-NW"), (2.5, "DE"), (3.5, "DE")]
