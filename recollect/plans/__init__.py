"""Every operator as a query over the given tables, with its SQL where there is one."""

from importlib import import_module

_MODULES = ("transcript", "embedding", "memory", "search", "audit", "protect", "streaming")


def registry() -> dict:
    """name -> (query, SQL or None)"""
    found: dict = {}
    for name in _MODULES:
        found.update(import_module(f"{__name__}.{name}").QUERIES)
    return found
