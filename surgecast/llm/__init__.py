"""Operators for building training-data corpora.

Nothing else in the library imports this package; it only uses the general
helpers in ``surgecast.session``. ``queries.py`` holds the thin registered
queries, the other modules the operators.
"""
