"""Imports every module that registers queries and hands out the two dictionaries."""

from __future__ import annotations

import importlib

from tabwright.plans import registry

MODULES = [
    "profiling", "shaping", "cleaning", "statistics", "selection", "splitting", "learned", "scoring", "modelling", "storage", "wide",
]


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"tabwright.plans.{name}")


def queries() -> dict[str, registry.Query]:
    _load()
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(registry.ORACLE)
