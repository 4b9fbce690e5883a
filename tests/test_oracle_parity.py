"""Every registered query equals its DuckDB oracle on the sf0.001 tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from hourcast.plans.queries import QUERIES
from tests.conftest import SF

TABLES = ["events"]


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        t = []
        for i in order:
            v = r[i]
            if isinstance(v, float):
                v = "nan" if math.isnan(v) else float(f"{v:.9g}")
            t.append(v)
        out.append(tuple(t))
    return [cols[i] for i in order], sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["day_utc", "region", "avg_load_mw", "min_load_mw", "max_load_mw",
                          "avg_temp_c"]
    assert df.count() > 0


def test_every_query_has_oracle():
    assert set(QUERIES) == {k for k in E.oracle_sql() if k in QUERIES} and set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    s_cols, s_rows = _norm([tuple(r) for r in df.collect()], df.columns)
    cur = duck.execute(E.oracle_sql()[name])
    d_cols, d_rows = _norm(cur.fetchall(), [d[0] for d in cur.description])
    assert s_cols == d_cols
    assert s_rows == d_rows
