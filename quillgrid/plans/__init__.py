"""The registered queries."""

from importlib import import_module

from .registry import ORACLES, QUERIES

for _module in ("relational", "profile", "retrieval", "evaluation", "maintenance"):
    import_module(f"{__name__}.{_module}")

__all__ = ["ORACLES", "QUERIES"]
