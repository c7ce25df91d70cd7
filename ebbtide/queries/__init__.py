"""All registered queries; importing this package fills the registry."""

from importlib import import_module

from .registry import ORACLES, QUERIES

for _module in ("tables", "features", "splits", "metrics", "drift", "models", "runs", "checked"):
    import_module(f"{__name__}.{_module}")

__all__ = ["ORACLES", "QUERIES"]
