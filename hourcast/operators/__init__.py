"""DataFrame operators: windows, rollups, joins, top-k, upsert merges, quality."""
