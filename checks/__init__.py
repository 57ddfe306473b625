"""Registered checks: each is a Spark query over the given tables with its DuckDB counterpart."""
