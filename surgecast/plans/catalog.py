"""Import every query module so the registry is complete."""

from __future__ import annotations

import importlib

from surgecast.plans.registry import REGISTRY, Query

MODULES = [
    "surgecast.plans.attribution",
    "surgecast.plans.events",
    "surgecast.plans.enrichment",
    "surgecast.plans.series_q",
    "surgecast.plans.features_q",
    "surgecast.plans.forecast_q",
    "surgecast.plans.anomaly_q",
    "surgecast.plans.decide_q",
    "surgecast.plans.io_q",
    "surgecast.plans.streaming_q",
]


def registry() -> dict[str, Query]:
    for m in MODULES:
        importlib.import_module(m)
    return dict(REGISTRY)
