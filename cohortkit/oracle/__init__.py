"""Independent DuckDB oracle: the fixture view and one SQL text per registered query."""
