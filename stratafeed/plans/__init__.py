"""Whole steps: user SQL into tables, and the layers of the match feed."""

from .sql_tables import refresh_sql_table, run_sql_table, run_sql_tables

__all__ = ["refresh_sql_table", "run_sql_table", "run_sql_tables"]
