"""Every query of the subpackage with SQL equals it on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF
from hourcast.llm.queries import ORACLE_SQL, QUERIES


def test_all_queries_are_registered():
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(QUERIES)
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "conversations", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    cur = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.select(*columns).collect()), key=str) == sorted(cur.fetchall(), key=str)
