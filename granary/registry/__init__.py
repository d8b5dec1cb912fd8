"""Lookup of every table the pipeline knows."""

from granary.registry.base import AUDIT_COLUMNS, SourceTable, WarehouseTable
from granary.registry.person import PERSON_TABLES
from granary.registry.production import PRODUCTION_TABLES
from granary.registry.sales import SALES_TABLES
from granary.registry.warehouse import WAREHOUSE_TABLES

SOURCES: dict[str, SourceTable] = {
    t.full_name: t for t in (*SALES_TABLES, *PERSON_TABLES, *PRODUCTION_TABLES)
}
WAREHOUSE: dict[str, WarehouseTable] = {t.name: t for t in WAREHOUSE_TABLES}


def source(name: str) -> SourceTable:
    """Find a table by ``Schema_Name`` or, where it is unambiguous, by name."""
    if name in SOURCES:
        return SOURCES[name]
    found = [t for t in SOURCES.values() if t.name == name]
    if len(found) != 1:
        raise KeyError(f"{len(found)} source tables are called {name!r}")
    return found[0]


def active_sources() -> list[SourceTable]:
    return [t for t in SOURCES.values() if t.active]


__all__ = [
    "AUDIT_COLUMNS",
    "SOURCES",
    "WAREHOUSE",
    "SourceTable",
    "WarehouseTable",
    "active_sources",
    "source",
]
