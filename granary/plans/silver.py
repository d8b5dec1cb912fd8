"""Silver jobs: one generic job, driven by the table registry."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.operators import checks, conform, dedup, fills
from granary.operators.fills import AsOf
from granary.registry import AUDIT_COLUMNS, SourceTable


@dataclass(frozen=True)
class Cleaned:
    """Result of a silver job before it is written."""

    accepted: DataFrame
    quarantined: DataFrame


def latest_rows(bronze: DataFrame, table: SourceTable) -> DataFrame:
    """The last modified row per key; ties fall to the highest remaining values."""
    business = [f.name for f in table.struct if f.name not in AUDIT_COLUMNS]
    tiebreak = [c for c in business if c not in table.keys and c != table.order_by]
    return dedup.keep_latest(bronze, table.keys, table.order_by, tiebreak)


def fill_missing(rows: DataFrame, table: SourceTable, as_of: AsOf = None) -> DataFrame:
    rows = fills.fill_constants(rows, table.constants)
    rows = fills.fill_times(rows, table.all_stamps, as_of)
    if table.row_id is not None and table.fill_row_id:
        rows = fills.fill_row_id(rows, table.full_name, table.keys)
    rows = fills.fill_derived(rows, table.derived)
    rows = fills.guard_totals(rows, table.guarded)
    return fills.trim_columns(rows, table.trimmed)


def check_rows(
    bronze: DataFrame, table: SourceTable, as_of: AsOf = None, rules: Mapping[str, str] | None = None
) -> DataFrame:
    """Latest row per key, filled, with the names of the checks it fails.

    Checks run after the fills and before the cast. ``rules`` replaces the
    registry's checks, for tables that have more of them stored.
    """
    filled = fill_missing(latest_rows(bronze, table), table, as_of)
    return filled.withColumn(checks.FAILED, checks.failed_checks(table.checks if rules is None else rules))


def split(checked: DataFrame, table: SourceTable, wide_ids: bool = False) -> Cleaned:
    """Rows without a failed check, cast and verified, and the others as they came."""
    schema, passes = table.schema_for(wide_ids), F.size(checks.FAILED) == 0
    accepted = conform.cast_to(checked.filter(passes), schema)
    return Cleaned(conform.verify_schema(accepted, schema), checked.filter(~passes))


def clean(bronze: DataFrame, table: SourceTable, as_of: AsOf = None, wide_ids: bool = False) -> Cleaned:
    return split(check_rows(bronze, table, as_of), table, wide_ids)
