"""The archive's queries over the test tables. load() fills the registry."""

from __future__ import annotations

import importlib

MODULES = ("lookups", "joins", "aggregates", "sequences", "scalars", "state", "archive", "ingest", "feeds")


def load():
    """The registry with every query of every module in it."""
    for m in MODULES:
        importlib.import_module(f"storyloom.plans.{m}")
    return importlib.import_module("storyloom.plans.registry")
