"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANK = "_rank"


def keep_latest(
    df: DataFrame, keys: Sequence[str], order_by: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Keep the row with the highest ``order_by`` per key; NULLs come last.

    Rows that tie are settled by ``tiebreak``, highest first, so that a rerun
    keeps the same row. Spark puts a group limit before the shuffle: each map
    task passes on one row per key, however many copies a key has.
    """
    latest = Window.partitionBy(*keys).orderBy(
        *[F.col(c).desc_nulls_last() for c in (order_by, *tiebreak)]
    )
    ranked = df.withColumn(RANK, F.row_number().over(latest))
    return ranked.filter(F.col(RANK) == 1).drop(RANK)


def one_per_key(df: DataFrame, keys: Sequence[str], lowest: Sequence[str]) -> DataFrame:
    """Keep the row with the lowest ``lowest`` columns per key.

    Written as an aggregate, so that it is combined before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys and c not in lowest]
    row = F.min(F.struct(*lowest, *rest)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*df.columns)
