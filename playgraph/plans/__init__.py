"""Query registry (Spark plans) and their DuckDB reference SQL."""
