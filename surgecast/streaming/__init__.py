"""Structured Streaming forms of the traffic and anomaly operators."""
