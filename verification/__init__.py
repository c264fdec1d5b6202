"""Registered queries and the independent SQL each one is checked against."""

from importlib import import_module

MODULES = ["sources", "scalars", "joins", "aggregates", "windows", "splits", "reports", "models", "plans", "streams"]


def load_checks():
    from verification import registry

    for m in MODULES:
        import_module(f"verification.{m}")
    return registry.QUERIES, registry.ORACLES
