"""Relational and time-series operators: DataFrame(s) in, DataFrame out."""
