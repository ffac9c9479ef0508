"""Query plans: the registry of named queries and their SQL oracles, plus plan utilities."""

import importlib

MODULES = ("shop", "activity", "queue", "stock", "checks", "layouts", "streams", "tableops")


def load_all():
    """Import every module that registers queries; returns (queries, sql)."""
    from tidemark.plans.registry import QUERIES, SQL

    for mod in MODULES:
        importlib.import_module(f"tidemark.plans.{mod}")
    return QUERIES, SQL
