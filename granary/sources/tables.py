"""Versioned Parquet tables with a write, audit, publish cycle.

Plain Parquet tables can neither be merged into nor overwritten while they are
read. Each load therefore writes a whole new version ``vN`` next to the old
one, checks the written files, and publishes the version by creating one small
marker file in it. Readers use the highest published version, so a load that
fails half way or breaks a rule leaves the table as it was. One writer per
table is assumed.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from granary.operators.checks import declare_checks, read_checks
from granary.operators.identity import assign_identity
from granary.operators.ordered import cluster_rows
from granary.operators.sync import (
    align_columns,
    change_feed,
    duplicate_keys,
    key_changes,
    row_digests,
    sync_counts,
    to_sink,
    to_sink_in_part,
)
from granary.sources import files

MARKER = "_PUBLISHED"


class TableNotFound(Exception):
    """A table was read or merged into before its first load."""


class RuleViolation(Exception):
    """A load broke a key or a required-column rule; the old version stays."""


class VersionedTable:
    """One table at ``path``; ``name`` is its catalog name, ``database.table``.

    ``retain`` is how many versions a load leaves, the new one included; all by
    default. ``cluster`` are columns that the files of a new version are laid out by.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        name: str | None = None,
        retain: int | None = None,
        cluster: Sequence[str] = (),
    ) -> None:
        self.spark, self.path, self.name = spark, path.rstrip("/"), name
        self.retain, self.cluster = retain, cluster

    def versions(self) -> list[int]:
        names = files.child_names(self.spark, self.path)
        return sorted(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit())

    def version(self) -> int | None:
        for number in reversed(self.versions()):
            if files.exists(self.spark, f"{self.location(number)}/{MARKER}"):
                return number
        return None

    def location(self, version: int) -> str:
        return f"{self.path}/v{version}"

    def exists(self) -> bool:
        return self.version() is not None

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version; its schema comes from the marker, so no file is opened yet."""
        number = self.version() if version is None else version
        if number is None:
            raise TableNotFound(self.name or self.path)
        schema = StructType.fromJson(self.notes(number)["schema"])
        return self.spark.read.schema(schema).parquet(self.location(number))

    def notes(self, version: int | None = None) -> dict[str, Any]:
        """What a version's marker records: schema, row count and highest identity."""
        number = self.version() if version is None else version
        if number is None:
            return {}
        return json.loads(files.read_text(self.spark, f"{self.location(number)}/{MARKER}"))

    def publish(
        self,
        rows: DataFrame,
        required: Sequence[str] = (),
        unique: Sequence[str] = (),
        notes: Mapping[str, Any] | None = None,
        defaults: Mapping[str, str] | None = None,
        declared: StructType | None = None,
        null_safe: bool = False,
        keys: Sequence[str] = (),
        audit: Callable[[DataFrame], DataFrame] | None = None,
    ) -> int:
        """Write ``rows`` as the next version, audit it and make it current.

        ``declared`` is the schema with its NOT NULL marks for the catalog,
        where it says more than that of ``rows``.

        ``audit`` returns rows that must not be there, from the written ones.

        Missing required values are counted while the rows are written. Key
        uniqueness is checked on the key columns of the written files, so the
        plan behind ``rows`` runs once only.
        """
        number = max(self.versions(), default=-1) + 1
        seen = Observation()
        laid_out = cluster_rows(rows, self.cluster) if self.cluster else rows
        measured = laid_out.observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"missing_{c}") for c in required],
        )
        measured.write.mode("overwrite").option("compression", "zstd").parquet(self.location(number))
        counts = seen.get
        written = self.spark.read.schema(rows.schema).parquet(self.location(number))
        missing = {c: counts[f"missing_{c}"] for c in required if counts[f"missing_{c}"]}
        if missing:
            empty = written.filter(reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in missing]))
            named = [c for c in keys or unique if c in written.columns] or written.columns[:3]
            examples = [tuple(r) for r in empty.select(*[f"`{c}`" for c in named]).limit(5).collect()]
            raise RuleViolation(
                f"{self.name or self.path}: required values missing: {missing}; at {tuple(named)}: {examples}"
            )
        if unique:
            doubled = duplicate_keys(written, unique, null_safe).limit(5).collect()
            if doubled:
                keys = [tuple(r)[:-1] for r in doubled]
                raise RuleViolation(f"{self.name or self.path}: keys {tuple(unique)} repeat: {keys}")
        if audit:
            wrong = [tuple(r) for r in audit(written).limit(5).collect()]
            if wrong:
                raise RuleViolation(f"{self.name or self.path}: rows that the audit refuses: {wrong}")
        schema = declared or rows.schema
        record = {"rows": counts["rows"], "schema": schema.jsonValue(), **(notes or {})}
        files.write_text(self.spark, f"{self.location(number)}/{MARKER}", json.dumps(record))
        self.register(schema, number, defaults)
        self.forget_versions()
        return number

    def forget_versions(self) -> None:
        """Remove what is older than the last ``retain`` versions."""
        if self.retain:
            for number in self.versions()[: -self.retain]:
                files.delete(self.spark, self.location(number))
            kept = {str(n) for n in self.versions()}
            for name in files.child_names(self.spark, self.path):
                if name.startswith("digests-") and name.split("-")[1] not in kept:
                    files.delete(self.spark, f"{self.path}/{name}")

    def register(
        self, schema: StructType, version: int, defaults: Mapping[str, str] | None = None
    ) -> None:
        """Point the catalog table at a version, creating the entry on first use."""
        if self.name is None:
            return
        location, kept = self.location(version), {}
        known = self.spark.catalog.tableExists(self.name)
        if known and not same_columns(self.spark.table(self.name).schema, schema):
            # Only the catalog entry goes: the table is external. Its checks come back below.
            kept = read_checks(self.spark, self.name)
            self.spark.sql(f"DROP TABLE {self.name}")
            known = False
        if not known:
            self.spark.sql(
                f"CREATE TABLE {self.name} ({table_ddl(schema, defaults or {})}) "
                f"USING parquet LOCATION '{location}'"
            )
            declare_checks(self.spark, self.name, kept)
        else:
            self.spark.sql(f"ALTER TABLE {self.name} SET LOCATION '{location}'")
            self.spark.sql(f"REFRESH TABLE {self.name}")

    def sync(
        self,
        source: DataFrame,
        keys: Sequence[str],
        schema: StructType,
        identity: str | None = None,
        null_safe: bool = False,
        required: Sequence[str] = (),
        keys_unique: bool = False,
        defaults: Mapping[str, str] | None = None,
        audit: Callable[[DataFrame], DataFrame] | None = None,
        notes: Mapping[str, Any] | None = None,
        finish: Callable[[DataFrame], DataFrame] | None = None,
    ) -> int:
        """Full-sync merge of ``source`` into the table; see :mod:`granary.operators.sync`.

        ``keys_unique`` says that the plan behind ``source`` already yields one
        row per key, which saves the duplicate check. ``notes`` are kept with
        the version. ``finish`` adds the columns that ``source`` lacks once its
        rows have their surrogate key, so that long texts stay out of that join.
        """
        rows = to_sink_in_part(source, schema) if finish else to_sink(source, schema, (identity,) if identity else ())
        notes = dict(notes or {})
        if identity:
            old = self.read() if self.exists() else None
            rows, highest = assign_identity(
                rows, old, keys, identity, self.highest(identity, old), null_safe
            )
            rows, notes = rows if finish else rows.select(*schema.names), notes | {"highest": highest}
        if finish:
            rows = to_sink(finish(rows), schema)
        unique = () if keys_unique else keys
        return self.publish(rows, required, unique, notes, defaults, schema, null_safe, keys, audit)

    def sync_evolving(self, source: DataFrame, keys: Sequence[str], unique: bool = False) -> int:
        """Full-sync merge that accepts new columns; columns that went missing become NULL.

        Rows are taken as they are, repeated keys included, for silver resolves
        them. With ``unique`` a reload with a repeated key raises instead.
        """
        if not self.exists():
            return self.publish(source)
        return self.publish(align_columns(source, self.read().schema), unique=keys if unique else ())

    def highest(self, identity: str, old: DataFrame | None) -> int:
        """Highest identity ever given out, so that a deleted row's key is not used again."""
        if old is None:
            return 0
        noted = self.notes().get("highest")
        return noted if noted is not None else old.agg(F.max(identity)).first()[0] or 0

    def changes(self, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
        """Inserted, updated and deleted rows between the last two published versions."""
        current, earlier = self.last_two()
        new = self.read(current)
        old = self.read(earlier) if earlier is not None else new.limit(0)
        return sync_counts(new, old, keys, null_safe)

    def last_two(self) -> tuple[int, int | None]:
        """The current version and the published one before it, if there is one."""
        current = self.version()
        if current is None:
            raise TableNotFound(self.name or self.path)
        earlier = [
            n for n in self.versions() if n < current and files.exists(self.spark, f"{self.location(n)}/{MARKER}")
        ]
        return current, earlier[-1] if earlier else None


    def keep_digests(self, keys: Sequence[str], version: int | None = None) -> DataFrame:
        """Keys and row digests of a version, worked out once and kept beside it."""
        number = self.version() if version is None else version
        if number is None:
            raise TableNotFound(self.name or self.path)
        path = f"{self.path}/digests-{number}-{'-'.join(keys)}"
        if not files.exists(self.spark, f"{path}/_SUCCESS"):
            digests = row_digests(self.read(number), keys)
            digests.write.mode("overwrite").option("compression", "zstd").parquet(path)
        schema = row_digests(self.read(number).limit(0), keys).schema
        return self.spark.read.schema(schema).parquet(path)

    def feed(self, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
        """The rows that the last load inserted, changed and deleted; see :func:`change_feed`.

        The digests of the older version are kept from the load before, so
        only the new version is read for the comparison.
        """
        new, old = self.last_two()
        was = self.keep_digests(keys, old) if old is not None else row_digests(self.read(new).limit(0), keys)
        rows = self.read(new)
        before = self.read(old) if old is not None else rows.limit(0)
        return change_feed(rows, before, keys, null_safe, self.keep_digests(keys, new), was)

    def key_changes(self, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
        """What became of each key with the last load, unchanged ones included."""
        new, old = self.last_two()
        now = self.keep_digests(keys, new)
        return key_changes(now, now.limit(0) if old is None else self.keep_digests(keys, old), keys, null_safe)


def same_columns(a: StructType, b: StructType) -> bool:
    return [(f.name, f.dataType) for f in a] == [(f.name, f.dataType) for f in b]


def table_ddl(schema: StructType, defaults: Mapping[str, str]) -> str:
    """Column list for CREATE TABLE with NOT NULL and DEFAULT."""
    parts = []
    for f in schema:
        rule = "" if f.nullable else " NOT NULL"
        default = f" DEFAULT {defaults[f.name]}" if f.name in defaults else ""
        parts.append(f"`{f.name}` {f.dataType.simpleString()}{rule}{default}")
    return ", ".join(parts)


def create_layers(spark: SparkSession, root: str, prefix: str = "") -> None:
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{layer} LOCATION '{root.rstrip('/')}/{layer}'")
