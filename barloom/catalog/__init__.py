"""Every query of the engine with its SQL statement."""

from __future__ import annotations

from importlib import import_module

from barloom.catalog.base import Catalog

_MODULES = ("market", "cleaning", "tables", "landing", "articles", "streams")


def load() -> Catalog:
    whole = Catalog()
    for name in _MODULES:
        part = import_module(f"barloom.catalog.{name}").catalog
        twice = whole.queries.keys() & part.queries.keys()
        if twice:
            raise ValueError(f"registered twice: {sorted(twice)}")
        whole.queries.update(part.queries)
        whole.sql.update(part.sql)
    return whole
