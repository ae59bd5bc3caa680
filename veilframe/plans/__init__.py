"""Registered queries, one module per operator family."""

from importlib import import_module
from pathlib import Path


def load():
    """Import every query module once and return the registry."""
    for path in sorted(Path(__file__).parent.glob("*_queries.py")):
        import_module(f"{__name__}.{path.stem}")
    return import_module(f"{__name__}.registry")
