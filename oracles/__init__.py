"""Independent DuckDB oracles for every registered query (test support)."""
