"""Versioned rows: pick the version valid at a time, find overlapping versions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.operators.joins import by_measure
from granary.operators.ordered import PARTITION, POSITION, place_in_order
from granary.session import stored


def valid_at(when: Column, start: Column, end: Column, as_of: Column) -> Column:
    """Inclusive at both ends; an open version runs up to ``as_of``."""
    return when.between(start, F.coalesce(end, as_of))


def join_valid_version(
    rows: DataFrame, versions: DataFrame, same_key: Column, when: Column, start: Column, end: Column,
    as_of: Column,
) -> DataFrame:
    """Left join each row to the versions of its key that are valid at its time.

    The equality on the key carries the join, the range is only a filter on the
    matches. Small versions are broadcast by their measured size, large ones
    are sort-merged, and adaptive execution splits a hot key on the row side.
    """
    return rows.join(versions, same_key & valid_at(when, start, end, as_of), "left")


def join_as_of(
    rows: DataFrame,
    versions: DataFrame,
    row_keys: Sequence[Column],
    when: Column,
    version_keys: Sequence[str],
    start: str,
    end: str,
    as_of: Column,
    name: str = "v",
) -> DataFrame:
    """The result of :func:`join_valid_version` without meeting every version of a key.

    The distinct pairs of key and time are put in one order with the starts of
    the versions, across range partitions, and each takes the last version that
    started before it: one candidate, however many versions its key has. A
    version that is still valid when the next one of its key starts (they touch
    or overlap) is matched again over that rest of its time, by equality where
    the rest is one moment. The rows themselves are only joined to the matches
    of their key and time, so they neither multiply nor move for the search.

    The columns of ``versions`` are found under the alias ``name``.
    """
    keys = [f"_k{i}" for i in range(len(row_keys))]
    order = [*keys, "_at", "_tag", "_end", "_mark"]
    row = F.struct(*[F.col(f"`{c}`") for c in versions.columns])
    starts = versions.select(
        *[F.col(f"`{c}`").alias(k) for c, k in zip(version_keys, keys)],
        F.col(f"`{start}`").alias("_at"),
        F.coalesce(F.col(f"`{end}`"), as_of).alias("_end"),
        F.xxhash64(*[F.col(f"`{c}`") for c in versions.columns]).alias("_mark"),
        row.alias("_row"),
    ).filter(F.col("_at") <= F.col("_end"))
    times = rows.select(*[c.alias(k) for c, k in zip(row_keys, keys)], when.alias("_at")).distinct()
    searched = times.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, "_at"]]))
    placed = place_in_order(
        starts.withColumn("_tag", F.lit(0)).unionByName(searched.withColumn("_tag", F.lit(1)), allowMissingColumns=True),
        order,
    )
    found = _last_started(placed, keys).filter(F.col("_at") <= F.col("_found._end"))
    matches = found.select(*keys, "_at", F.col("_found._row").alias("_row"))
    rests = stored(_still_valid(placed, keys), "still-valid")
    if not rests.isEmpty():
        s, moment = searched.alias("s"), F.col("_from") == F.col("_to")
        same = [F.col(f"s.{k}") == F.col(f"r.{k}") for k in keys]
        for part, at in (
            (rests.filter(moment), F.col("s._at") == F.col("r._from")),
            (rests.filter(~moment), F.col("s._at").between(F.col("r._from"), F.col("r._to"))),
        ):
            again = s.join(part.alias("r"), reduce(lambda a, b: a & b, [*same, at]))
            matches = matches.unionByName(again.select("s.*", "r._row"))
    matches = stored(matches, "version-matches").withColumnRenamed("_at", "_when")
    same_time = [c == F.col(f"{name}.{k}") for c, k in zip([*row_keys, when], [*keys, "_when"])]
    flat = by_measure(matches.select(*keys, "_when", "_row.*")).alias(name)
    return rows.join(flat, reduce(lambda a, b: a & b, same_time), "left").drop(
        *[F.col(f"{name}.{k}") for k in [*keys, "_when"]]
    )


def _last_started(placed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The searched times, each with the last version of its key that started by then as ``_found``."""
    here = [PARTITION, *keys]
    version = F.when(F.col("_tag") == 0, F.struct("_end", "_row"))
    upto = Window.partitionBy(*here).orderBy(POSITION).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(*keys).orderBy(PARTITION).rowsBetween(Window.unboundedPreceding, -1)
    brought = (
        placed.groupBy(*here)
        .agg(F.max_by(F.struct("_end", "_row"), F.when(F.col("_tag") == 0, F.col(POSITION))).alias("_own"))
        .withColumn("_brought", F.last("_own", ignorenulls=True).over(earlier))
        .filter(F.col("_brought").isNotNull())
        .drop("_own")
    )
    local = placed.withColumn("_local", F.last(version, ignorenulls=True).over(upto)).filter("_tag = 1")
    found = local.select(*here, "_at", "_local").join(brought, here, "left")
    return found.withColumn("_found", F.coalesce("_local", "_brought")).filter(F.col("_found").isNotNull())


def _still_valid(placed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Versions that are valid at the start of the next one of their key, and from when to when they are."""
    here = [PARTITION, *keys]
    starts = placed.filter("_tag = 0")
    later = Window.partitionBy(*keys).orderBy(F.col(PARTITION).desc()).rowsBetween(Window.unboundedPreceding, -1)
    ahead = (
        starts.groupBy(*here)
        .agg(F.min("_at").alias("_own"))
        .withColumn("_ahead", F.min("_own").over(later))
        .filter(F.col("_ahead").isNotNull())
        .drop("_own")
    )
    local = starts.withColumn("_next", F.lead("_at").over(Window.partitionBy(*here).orderBy(POSITION)))
    joined = local.join(ahead, here, "left").withColumn("_from", F.coalesce("_next", "_ahead"))
    return joined.filter(F.col("_from") <= F.col("_end")).select(*keys, "_from", F.col("_end").alias("_to"), "_row")


def match_open_ranges(left_end: Column, right_end: Column) -> Column:
    """Equal end dates, where two open ends are equal too."""
    return left_end.eqNullSafe(right_end)


def overlapping_versions(
    versions: DataFrame, keys: Sequence[str], order: str, start: str, end: str, as_of: Column
) -> DataFrame:
    """Versions that start on or before the end of an earlier version of their key.

    A running maximum replaces the join of every pair of versions, so the work
    grows with the number of versions and not with its square. The maximum runs
    within range partitions, and what a key brings along from its earlier
    partitions is added afterwards, so a key with very many versions is split.
    """
    ends = F.coalesce(F.col(end), as_of)
    placed = place_in_order(versions, [*keys, order])
    here = [PARTITION, *keys]
    earlier_rows = Window.partitionBy(*here).orderBy(POSITION).rowsBetween(
        Window.unboundedPreceding, -1
    )
    earlier_parts = Window.partitionBy(*keys).orderBy(PARTITION).rowsBetween(
        Window.unboundedPreceding, -1
    )
    brought = (
        placed.groupBy(*here)
        .agg(F.max(ends).alias("_end"))
        .withColumn("_brought", F.max("_end").over(earlier_parts))
        .filter(F.col("_brought").isNotNull())
        .drop("_end")
    )
    local = placed.withColumn("_local", F.max(ends).over(earlier_rows))
    joined = local.join(brought, here, "left")
    return (
        joined.withColumn("earlier_end", F.greatest("_local", "_brought"))
        .filter(F.col(start) <= F.col("earlier_end"))
        .select(*versions.columns, "earlier_end")
    )
