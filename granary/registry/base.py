"""Table descriptions that drive the bronze, silver and gold jobs."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import cached_property
from typing import Any

from pyspark.sql import Column
from pyspark.sql.types import StructType

AUDIT_COLUMNS = ("_process_timestamp", "_input_file_name")


@dataclass(frozen=True)
class SourceTable:
    """One operational table and the rules its silver job applies.

    ``columns`` is DDL text without the columns most tables share. Those are
    appended by :attr:`ddl` in a fixed order: row id, modification time, load
    time, source file. ``row_id`` and ``modified`` hold the nullability suffix
    of the shared column, or None where the table lacks it.
    """

    schema: str
    name: str
    keys: tuple[str, ...]
    columns: str
    row_id: str | None = None
    fill_row_id: bool = True
    modified: str | None = "NOT NULL"
    constants: Mapping[str, Any] = field(default_factory=dict)
    stamps: tuple[str, ...] = ()
    derived: Mapping[str, tuple[Callable[[Column], Column], str]] = field(default_factory=dict)
    guarded: Mapping[str, str] = field(default_factory=dict)
    trimmed: tuple[str, ...] = ()
    checks: Mapping[str, str] = field(default_factory=dict)
    extract_query: str | None = None
    active: bool = True

    @property
    def full_name(self) -> str:
        return f"{self.schema}_{self.name}"

    @property
    def ddl(self) -> str:
        parts = [self.columns.strip().rstrip(",")]
        if self.row_id is not None:
            parts.append(f"rowguid STRING {self.row_id}")
        if self.modified is not None:
            parts.append(f"ModifiedDate TIMESTAMP {self.modified}")
        parts += ["_process_timestamp TIMESTAMP NOT NULL", "_input_file_name STRING NOT NULL"]
        return ", ".join(p.strip() for p in parts)

    @cached_property
    def struct(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @cached_property
    def wide_struct(self) -> StructType:
        return StructType.fromDDL(widen_ids(self.ddl))

    def schema_for(self, wide_ids: bool = False) -> StructType:
        return self.wide_struct if wide_ids else self.struct

    @property
    def order_by(self) -> str:
        """Column that decides which copy of a key is the latest."""
        return "ModifiedDate" if self.modified is not None else "_process_timestamp"

    @property
    def all_stamps(self) -> tuple[str, ...]:
        modified = ("ModifiedDate",) if self.modified is not None else ()
        return (*self.stamps, *modified, "_process_timestamp")

    @property
    def defaults(self) -> dict[str, str]:
        """Column defaults for the table DDL, as SQL text."""
        values = {c: sql_literal(v) for c, v in self.constants.items()}
        return values | {c: "current_timestamp()" for c in self.all_stamps}

    @property
    def required(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.struct if not f.nullable)


@dataclass(frozen=True)
class WarehouseTable:
    """One gold table: its column DDL, merge key and surrogate key.

    ``unique_by_build`` marks builds that cannot repeat a key, because the key
    is that of one silver table or a numbered line; the others are checked.
    """

    name: str
    columns: str
    keys: tuple[str, ...]
    sources: tuple[str, ...] = ()
    identity: str | None = None
    null_safe_keys: bool = False
    unique_by_build: bool = False
    active: bool = True

    @cached_property
    def struct(self) -> StructType:
        return StructType.fromDDL(self.columns.strip().rstrip(","))

    @cached_property
    def wide_struct(self) -> StructType:
        return StructType.fromDDL(widen_ids(self.columns.strip().rstrip(",")))

    def schema_for(self, wide_ids: bool = False) -> StructType:
        return self.wide_struct if wide_ids else self.struct

    @property
    def required(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.struct if not f.nullable)


def widen_ids(ddl: str) -> str:
    """The same DDL with 32-bit key columns as BIGINT.

    Order numbers outgrow 32 bits long before 100 TB of order lines. Date keys
    stay as they are: yyyyMMdd always fits.
    """
    return re.sub(r"\b(\w+(?:ID|Key|AlternateKey))\s+INT\b(?!\w)", _widen_one, ddl)


def _widen_one(found: re.Match) -> str:
    name = found.group(1)
    return found.group(0) if name.endswith("DateKey") else f"{name} BIGINT"


def sql_literal(value: Any) -> str:
    if isinstance(value, bool):
        return "true" if value else "false"
    return str(value)
