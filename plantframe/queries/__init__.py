"""Registered queries over the test tables, each with its DuckDB oracle SQL (see common.py)."""
