"""Default values for missing data, and text clean-up."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEX_GROUPS = "^(.{8})(.{4})(.{4})(.{4})(.{12})$"

AsOf = Column | datetime.datetime | str | None


def run_time(as_of: AsOf = None) -> Column:
    """The load time of a run: now, or a given time for repeatable runs."""
    if as_of is None:
        return F.current_timestamp()
    column = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return column.cast("timestamp")


def fill_constants(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    return df.fillna(dict(values)) if values else df


def fill_times(df: DataFrame, columns: Sequence[str], as_of: AsOf = None) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("timestamp"), run_time(as_of)) for c in columns})


def row_id(label: str, keys: Sequence[str]) -> Column:
    """A row id made from the key, in UUID layout; the same key gives the same id.

    Each part goes in with its length in front, and a NULL part as ``-``, so
    that different keys never give the same text.
    """
    text = [F.col(f"`{k}`").cast("string") for k in keys]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]
    digest = F.md5(F.concat(F.lit(f"{label}|"), *parts))
    return F.regexp_replace(digest, HEX_GROUPS, "$1-$2-$3-$4-$5")


def fill_row_id(df: DataFrame, label: str, keys: Sequence[str], column: str = "rowguid") -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), row_id(label, keys)))


def fill_derived(
    df: DataFrame, expressions: Mapping[str, tuple[Callable[[Column], Column], str]]
) -> DataFrame:
    """Fill a column from a function of another column of its row."""
    if not expressions:
        return df
    return df.withColumns(
        {c: F.coalesce(F.col(c), derive(F.col(source))) for c, (derive, source) in expressions.items()}
    )


def guard_totals(df: DataFrame, operands: Mapping[str, str]) -> DataFrame:
    """Zero a total whose operands are incomplete; a complete one is not recomputed."""
    if not operands:
        return df
    return df.withColumns(
        {
            c: F.when(F.expr(sql).isNull(), F.lit(0).cast(df.schema[c].dataType)).otherwise(F.col(c))
            for c, sql in operands.items()
        }
    )


def trim_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.trim(F.col(c)) for c in columns}) if columns else df
