"""Column-expression builders (pure Catalyst, no Python UDFs)."""
