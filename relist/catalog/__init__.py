"""Registered queries and their oracles."""

from __future__ import annotations

from dataclasses import dataclass
from importlib import import_module

from relist.catalog.registry import ORACLES, QUERIES, Query

MODULES = ("values", "matching", "graph", "stores")


@dataclass(frozen=True)
class Catalog:
    queries: dict[str, Query]
    oracles: dict[str, str]


def load() -> Catalog:
    for name in MODULES:
        import_module(f"relist.catalog.{name}")
    return Catalog(QUERIES, ORACLES)
