"""Independent SQL formulation of every registered query, for DuckDB (the correctness oracle)."""
