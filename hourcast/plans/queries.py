"""All registered queries and their DuckDB SQL."""

from __future__ import annotations

from hourcast.plans import oracle, registry, store_queries, table_queries, time_queries

_MODULES = (registry, time_queries, table_queries, store_queries)

QUERIES = {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}
ORACLE_SQL = {name: sql for m in (oracle, *_MODULES[1:]) for name, sql in m.ORACLE_SQL.items()}
