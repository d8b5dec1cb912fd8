"""Surrogate keys that stay with their row across reloads."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.operators.ordered import PARTITION, POSITION, place_in_order
from granary.session import scratch_path

BEFORE = "_before"


def same_key(left: str, right: str, keys: Sequence[str], null_safe: bool = False) -> Column:
    """Equality of all key columns of two aliased frames."""
    pairs = [(F.col(f"{left}.`{k}`"), F.col(f"{right}.`{k}`")) for k in keys]
    return reduce(lambda a, b: a & b, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def complete_key(keys: Sequence[str]) -> Column:
    """TRUE where every part of the key is there."""
    return reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])


def number_keys(fresh: DataFrame, order: Sequence[str], identity: str, highest: int) -> tuple[DataFrame, int]:
    """Number rows after ``highest`` in the order of ``order``, without gaps.

    Rows are placed in range partitions; the number of rows per partition (one
    small row each) gives every partition its starting point. No step sees all
    rows at once.
    """
    placed = place_in_order(fresh, order)
    sizes = sorted((r[PARTITION], r["count"]) for r in placed.groupBy(PARTITION).count().collect())
    starts = list(accumulate((n for _, n in sizes), initial=highest))
    offsets = fresh.sparkSession.createDataFrame(
        [(p, start) for (p, _), start in zip(sizes, starts)], f"{PARTITION} bigint, {BEFORE} bigint"
    )
    # One row per partition: bounded by the partition count, not by the data.
    numbered = placed.join(F.broadcast(offsets), PARTITION).withColumn(
        identity, F.col(BEFORE) + F.col(POSITION) + 1
    )
    return numbered.select(identity, *fresh.columns), starts[-1]


def assign_identity(
    source: DataFrame,
    target: DataFrame | None,
    keys: Sequence[str],
    identity: str,
    highest: int = 0,
    null_safe: bool = False,
) -> tuple[DataFrame, int]:
    """Give each source row the key its match in ``target`` has, or a new one.

    Only the key columns of new rows are placed and numbered; all rows then
    take their number from the narrow table of keys in one join. It has a row
    for each of theirs, so it is sort-merged, whatever its files' size. Without
    new keys nothing is placed. Equal keys get one number, which the audit of the
    load refuses; a key that an older target repeats counts once.

    A key with a NULL part matches nothing unless ``null_safe``: each such row
    is a new one and is numbered by itself, ahead of the other new rows.
    Returns the keyed rows and the highest key.
    """
    path = scratch_path(source.sparkSession, "keys")
    source.select(*keys).distinct().write.parquet(path)
    found = source.sparkSession.read.parquet(path)
    whole, alone = source, None
    if not null_safe:
        whole, incomplete = source.filter(complete_key(keys)), found.filter(~complete_key(keys))
        found = found.filter(complete_key(keys))
        if not incomplete.isEmpty():
            alone, highest = number_keys(source.filter(~complete_key(keys)), keys, identity, highest)
    numbers = None
    if target is not None:
        numbers = target.groupBy(*keys).agg(F.min(F.col(identity).cast("bigint")).alias(identity))
        same = same_key("s", "t", keys, null_safe)
        found = found.alias("s").join(numbers.hint("merge").alias("t"), same, "left_anti").select("s.*")
    if numbers is None or not found.isEmpty():
        fresh, highest = number_keys(found, keys, identity, highest)
        numbers = fresh if numbers is None else numbers.select(identity, *keys).unionByName(fresh)
    keyed = whole.alias("s").join(numbers.hint("merge").alias("t"), same_key("s", "t", keys, null_safe)).select(
        f"t.{identity}", "s.*"
    )
    return (keyed if alone is None else keyed.unionByName(alone)), highest
