"""Schemas: cast to one, compare with one, report the differences."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType


class Difference(NamedTuple):
    column: str
    problem: str
    actual: str
    expected: str | None


def typed_null(data_type: str | DataType) -> Column:
    return F.lit(None).cast(data_type)


def cast_to(df: DataFrame, schema: StructType) -> DataFrame:
    """Select exactly the columns of ``schema``, cast to its types.

    A missing column raises, extra columns are dropped, and a value that does
    not fit its type raises when the plan runs.
    """
    present = set(df.columns)
    missing = [f.name for f in schema if f.name not in present]
    if missing:
        raise ValueError(f"columns missing from the input: {', '.join(missing)}")
    casts = [f"cast(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema]
    return df.selectExpr(*casts)


def strip_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def schema_differences(actual: StructType, expected: StructType) -> list[Difference]:
    """Extra columns and type differences. Nullability and missing columns do not count."""
    types = {f.name: f.dataType for f in expected}
    found = []
    for f in actual:
        if f.name not in types:
            found.append(Difference(f.name, "not expected", f.dataType.simpleString(), None))
        elif f.dataType != types[f.name]:
            wanted = types[f.name].simpleString()
            found.append(Difference(f.name, "different type", f.dataType.simpleString(), wanted))
    return found


def verify_schema(df: DataFrame, expected: StructType) -> DataFrame:
    """Return ``df`` unchanged, or raise with every difference."""
    found = schema_differences(df.schema, expected)
    if found:
        lines = [f"{d.column}: {d.problem} ({d.actual}, expected {d.expected})" for d in found]
        raise ValueError("schema differs: " + "; ".join(lines))
    return df


def schema_report(df: DataFrame, expected: StructType) -> DataFrame:
    """The differences as rows, with the number of values each one touches."""
    found = schema_differences(df.schema, expected)
    if not found:
        columns = "column string, problem string, actual string, expected string, filled bigint"
        return df.sparkSession.createDataFrame([], columns)
    counts = df.agg(*[F.count(F.col(f"`{d.column}`")).alias(f"n{i}") for i, d in enumerate(found)])
    rows = [
        F.struct(
            F.lit(d.column).alias("column"),
            F.lit(d.problem).alias("problem"),
            F.lit(d.actual).alias("actual"),
            F.lit(d.expected).cast("string").alias("expected"),
            F.col(f"n{i}").alias("filled"),
        )
        for i, d in enumerate(found)
    ]
    return counts.select(F.inline(F.array(*rows)))
