"""Scans and decoders: driver tables, reference-shaped views, file sources."""
