"""Imports every query module so the registry is complete."""

from __future__ import annotations

import importlib

from shelfrank.plans.registry import ORACLES, QUERIES

_MODULES = [
    "shelfrank.plans.q_eda",
    "shelfrank.plans.q_ranking",
    "shelfrank.plans.q_sequences",
    "shelfrank.plans.q_features",
    "shelfrank.plans.q_models",
    "shelfrank.plans.q_graph",
    "shelfrank.plans.q_evaluate",
    "shelfrank.plans.q_streaming",
]


def load_all():
    for m in _MODULES:
        importlib.import_module(m)
    return QUERIES, ORACLES
