"""Global order without a single task: rows placed in range partitions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.session import scratch_path, stored

PARTITION, POSITION = "_partition", "_position"
ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its lower 33 bits


def place_in_order(
    df: DataFrame, order: Sequence[str], first: Sequence[Column] = ()
) -> DataFrame:
    """Sort all rows by ``order`` across range partitions and fix their place.

    Adds the partition number and the row's position in it; partitions follow
    each other in the order of ``order``. Equal values are spread by a hash of
    the row, so a value that many rows share is split as well. ``first`` sorts
    ahead of ``order`` within each partition.

    The placed rows are written to the shared scratch folder and read back, so
    that every later step sees the same places even if executors are lost.
    """
    spark = df.sparkSession
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    row = F.monotonically_increasing_id()
    placed = (
        df.repartitionByRange(*order, spread)
        .sortWithinPartitions(*first, *order, spread)
        .withColumns(
            {
                PARTITION: F.shiftright(row, ROW_BITS),
                POSITION: row.bitwiseAND((1 << ROW_BITS) - 1),
            }
        )
    )
    path = scratch_path(spark, "placed")
    placed.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(placed.schema).parquet(path)


def cluster_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Lay rows out by ``columns`` for the files to come: ranges apart, sorted within."""
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)


def number_rows(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Number the rows of each group from 1, as an INT, whatever the group's size.

    Rows are placed in range partitions, so that a large group is spread over
    several; a row's number is its number within the partition plus the rows
    that its group has in earlier partitions. Every row is kept.
    """
    placed = place_in_order(df, [*group, *order])
    here = [PARTITION, *group]
    earlier = Window.partitionBy(*group).orderBy(PARTITION).rowsBetween(
        Window.unboundedPreceding, -1
    )
    # NULL groups are numbered too, so the parts are matched null-safely.
    before = (
        placed.groupBy(*here)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_earlier", F.sum("_n").over(earlier))
        .filter(F.col("_earlier") > 0)
        .select(*[F.col(c).alias(f"_key_{c}") for c in here], "_earlier")
    )
    local = placed.withColumn(
        name, F.row_number().over(Window.partitionBy(*here).orderBy(POSITION))
    )
    same_part = F.col(PARTITION) == F.col(f"_key_{PARTITION}")
    for c in group:
        same_part = same_part & F.col(c).eqNullSafe(F.col(f"_key_{c}"))
    number = F.col(name) + F.coalesce(F.col("_earlier"), F.lit(0))
    return local.join(before, same_part, "left").select(
        *df.columns, number.cast("int").alias(name)
    )


def number_in_lanes(
    df: DataFrame,
    group: Sequence[str],
    lanes: Sequence[str],
    order: Sequence[str],
    name: str,
    split: DataFrame | None = None,
) -> DataFrame:
    """Number the rows of each group from 1, as an INT, in the partitioning they already have.

    ``lanes`` are columns that cut a large group into parts, in the order of
    ``order``: equal order values share a lane, and later lanes hold later
    rows. Rows are numbered within group and lane, which a partitioning by any
    of these columns serves without another shuffle and without a sort of all
    rows. What earlier lanes of a group hold is counted apart and added.

    ``split`` has the group and lane columns of the rows whose groups may have
    several lanes, all rows by default. Only these are counted; a caller that
    knows them saves a second run of the plan behind ``df``.
    """
    parts = [*group, *lanes]
    local = df.withColumn(name, F.row_number().over(Window.partitionBy(*parts).orderBy(*order)))
    earlier = Window.partitionBy(*group).orderBy(*lanes).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        (df if split is None else split)
        .groupBy(*parts)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_earlier", F.sum("_n").over(earlier))
        .filter(F.col("_earlier") > 0)
        .select(*[F.col(c).alias(f"_key_{c}") for c in parts], "_earlier")
    )
    offsets = stored(offsets, "lane-offsets")
    number = F.col(name)
    if not offsets.isEmpty():
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in parts])
        local = local.join(offsets, same, "left")
        number = number + F.coalesce(F.col("_earlier"), F.lit(0))
    return local.select(*df.columns, number.cast("int").alias(name))


def split_groups(df: DataFrame, group: str, lane: Column) -> DataFrame:
    """Groups with rows in more than one lane, from one aggregate over two columns."""
    spans = df.groupBy(group).agg((F.min(lane) < F.max(lane)).alias("_several"))
    return spans.filter("_several").select(group)
