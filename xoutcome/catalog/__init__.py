"""The queries that the driver runs."""

from __future__ import annotations

from importlib import import_module

from xoutcome.catalog.base import REGISTRY, Query

MODULES = ["filters", "sources", "aggregates", "windows", "learning", "whole"]


def registered() -> dict[str, Query]:
    for module in MODULES:
        import_module(f"xoutcome.catalog.{module}")
    return REGISTRY
