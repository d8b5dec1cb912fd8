"""Connected components of a link table, as distributed stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import stored


def large_star(links: DataFrame) -> DataFrame:
    """Tie each node's larger neighbours to the smallest node around it."""
    both = links.unionByName(links.select(F.col("low").alias("high"), F.col("high").alias("low")))
    both = both.select(F.col("high").alias("node"), F.col("low").alias("other"))
    smallest = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("smallest"))
    tied = both.filter("other > node").join(smallest, "node")
    return tied.select(F.col("other").alias("high"), F.col("smallest").alias("low")).distinct()


def small_star(links: DataFrame) -> DataFrame:
    """Tie each node and its smaller neighbours to the smallest of them."""
    smallest = links.groupBy("high").agg(F.min("low").alias("smallest"))
    tied = links.join(smallest, "high").filter("low != smallest")
    moved = tied.select(F.col("low").alias("high"), F.col("smallest").alias("low"))
    own = smallest.select("high", F.col("smallest").alias("low"))
    return moved.unionByName(own).distinct()


def mark(links: DataFrame) -> tuple[int, int | None]:
    row = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("high", "low"))).first()
    return row[0], row[1]


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every linked node; the root is the smallest node reachable.

    ``links`` has bigint columns ``high`` and ``low`` with high > low. Both
    steps are repeated until nothing changes; each round is stored, so a lost
    executor costs one round at most. No links give no rows.
    """
    links = stored(links.distinct(), "links")
    seen = mark(links)
    while seen[0]:
        links = stored(small_star(large_star(links)), "stars")
        now = mark(links)
        if now == seen:
            break
        seen = now
    return links.select(F.col("high").alias("node"), F.col("low").alias("root")).unionByName(
        links.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    )
