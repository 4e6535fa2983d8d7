"""Registered queries and the SQL each is checked against."""

from __future__ import annotations

from importlib import import_module

from cairn_queries.registry import REGISTRY, Query

MODULES = ("models", "expressions", "relational", "sources", "quality", "profiling", "catalog", "derived")


def all_queries() -> dict[str, Query]:
    for module in MODULES:
        import_module(f"cairn_queries.{module}")
    return REGISTRY
