"""Registered queries, grouped by operator family."""

import importlib

MODULES = ["scans", "keyed", "scalars", "landed", "platforms", "runs", "results"]


def load():
    """(queries, SQL) of all families."""
    from gigloom.catalog import registry
    for name in MODULES:
        importlib.import_module(f"gigloom.catalog.{name}")
    return dict(registry.QUERIES), dict(registry.ORACLES)
