"""Joins whose shape matters for hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType


def left_join_many(left: DataFrame, many: DataFrame, key: str) -> DataFrame:
    """Left join of unique rows to a side with any number of rows per key.

    A left outer join can be split at run time on its left side only. Here the
    many rows of a hot key are on the right, so matches come from an inner
    join, which splits on either side, and rows without a match from an anti
    join with the distinct keys. The key column appears once.

    Both sides grow with the source, so neither is broadcast for its files'
    size; see :func:`by_measure`.
    """
    matched = left.join(many.hint("merge"), key, "inner")
    alone = left.join(many.select(key).distinct().hint("merge"), key, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


def bytes_in_memory(stored: DataFrame, enough: int | None = None) -> int:
    """What the rows of a stored frame take at least, once the driver or an executor has them in memory.

    From ``enough`` bytes on, the count of the rows tells, and texts are not read.
    """
    long = [f.name for f in stored.schema if isinstance(f.dataType, (StringType, BinaryType))]
    least = stored.count() * 8 * (1 + len(stored.columns))
    if not long or enough is not None and least > enough:
        return least
    lengths = stored.agg(*[F.coalesce(F.sum(F.octet_length(f"`{c}`")), F.lit(0)) for c in long]).first()
    return least + sum(lengths)


def by_measure(stored: DataFrame) -> DataFrame:
    """A stored frame that is sort-merged where its rows in memory pass the session's broadcast limit.

    The planner goes by the size of files, and files of numbers and repeated
    values take a small part of what their rows take in memory.
    """
    limit = stored.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return stored.hint("merge") if bytes_in_memory(stored, limit) > limit else stored
