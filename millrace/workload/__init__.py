"""Queries over the driver tables, by area."""

from __future__ import annotations

import importlib

from millrace.workload.registry import REGISTRY, Entry

AREAS = ["relational", "sources", "quality", "health", "retail", "retrieval", "logs", "streams"]


def load() -> dict[str, Entry]:
    for area in AREAS:
        importlib.import_module(f"{__name__}.{area}")
    return REGISTRY
