"""Pivot, line numbers and column projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.operators.ordered import number_rows


def pivot_first(
    df: DataFrame, keys: Sequence[str], pivot: Column, values: Mapping[str, str], pick: str, order: str
) -> DataFrame:
    """One row per key and one column per pivot value, holding the ``pick`` of lowest ``order``.

    ``values`` maps pivot values to column names. One aggregate serves all of
    them, so there is one shuffle of partial results and no job to discover
    the values. A value that does not occur gives a column of NULLs.
    """
    firsts = [
        F.min_by(F.when(pivot == value, F.col(pick)), F.when(pivot == value, F.col(order))).alias(name)
        for value, name in values.items()
    ]
    return df.groupBy(*keys).agg(*firsts)


def number_lines(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Number the rows of each group from 1, as a TINYINT.

    All rows are numbered and none is left out, so counts and sums over the
    result are exact; reading a number beyond the type's range raises.
    """
    return number_rows(df, group, order, name).withColumn(name, F.col(name).cast("tinyint"))


def project(df: DataFrame, columns: Mapping[str, Column | str]) -> DataFrame:
    """Select columns under new names."""
    return df.select(
        *[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()]
    )
