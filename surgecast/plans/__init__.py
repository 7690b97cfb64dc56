"""Registered queries: Spark plans over the driver tables plus DuckDB oracles."""
