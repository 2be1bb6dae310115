"""Imports every plan module so that its queries are registered."""

from __future__ import annotations

import importlib

MODULES = ("log_queries", "text_queries", "chain_queries", "policy_queries", "catalog_queries", "limit_queries")


def load() -> None:
    for module in MODULES:
        importlib.import_module(f"ledgerlens.plans.{module}")
