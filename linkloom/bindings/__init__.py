"""The jobs bound to the driver's test tables, each with its SQL counterpart."""

from __future__ import annotations

import importlib

MODULES = ("core", "text", "graph", "orgs", "people", "places", "evaluate", "sources", "streaming")


def _collect(attribute: str) -> dict:
    result: dict = {}
    for name in MODULES:
        result.update(getattr(importlib.import_module(f"linkloom.bindings.{name}"), attribute))
    return result


def queries() -> dict:
    return _collect("QUERIES")


def oracles() -> dict[str, str]:
    return _collect("ORACLES")
