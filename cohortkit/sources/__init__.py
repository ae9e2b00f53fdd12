"""Readers: OMOP parquet tables, the concept-set CSV, literal concept sets, the test fixture view."""
