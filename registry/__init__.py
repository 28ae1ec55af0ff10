"""Registered queries, one module per family."""

from __future__ import annotations

import importlib

FAMILIES = ["address_queries", "text_queries", "street_queries", "building_queries", "plan_queries"]


def load() -> tuple[dict, dict]:
    queries, oracles = {}, {}
    for f in FAMILIES:
        m = importlib.import_module(f"registry.{f}")
        twice = set(queries) & set(m.QUERIES)
        if twice:
            raise ValueError(f"registered twice: {sorted(twice)}")
        queries.update(m.QUERIES)
        oracles.update(m.ORACLES)
    return queries, oracles
