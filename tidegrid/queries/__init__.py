"""Queries over the standard tables: each module maps names to (query, SQL for DuckDB or None)."""
