"""Row checks: accept, reject, quarantine, required columns, stored checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PROPERTY_PREFIX = "granary.check."
FAILED = "_failed_checks"


def all_of(checks: Mapping[str, str]) -> Column:
    """One condition for all checks; no checks means TRUE."""
    return F.expr(" AND ".join(f"({sql})" for sql in checks.values()) or "true")


def accept(df: DataFrame, checks: Mapping[str, str]) -> DataFrame:
    """Rows for which every check is TRUE."""
    return df.filter(all_of(checks))


def reject_false(df: DataFrame, checks: Mapping[str, str]) -> DataFrame:
    """Rows for which the checks together are FALSE. A NULL result is in neither set."""
    return df.filter(~all_of(checks))


def failed_checks(checks: Mapping[str, str]) -> Column:
    """Names of the checks that are FALSE or NULL."""
    names = [
        F.when(~F.coalesce(F.expr(f"({sql})"), F.lit(False)), F.lit(name))
        for name, sql in checks.items()
    ]
    return F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")


def quarantine(df: DataFrame, checks: Mapping[str, str]) -> DataFrame:
    """Every row that :func:`accept` leaves out, with the names of its failed checks."""
    held = df.filter(~F.coalesce(all_of(checks), F.lit(False)))
    return held.withColumn(FAILED, failed_checks(checks))


def check_counts(checked: DataFrame, names: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """One row per check: ``check_name, failed`` and the lowest and highest failing key as examples.

    ``checked`` has the names of each row's failed checks. All checks are
    counted in one aggregate, which is combined before the shuffle; a check
    that no row fails has a row too.
    """
    key = F.struct(*[F.col(f"`{k}`") for k in keys])
    sums: list[Column] = []
    for i, name in enumerate(names):
        fails = F.array_contains(FAILED, name)
        found = F.when(fails, key)
        sums += [F.count_if(fails).alias(f"n{i}"), F.min(found).alias(f"low{i}"), F.max(found).alias(f"high{i}")]
    entries = [
        F.struct(F.lit(n).alias("check_name"), F.col(f"n{i}").alias("failed"), F.col(f"low{i}").alias("low"),
                 F.col(f"high{i}").alias("high"))
        for i, n in enumerate(names)
    ]
    found = checked.agg(*sums).select(F.inline(F.array(*entries)))
    ends = [F.col(f"{end}.{k}").alias(f"{side}_{k}") for side, end in (("first", "low"), ("last", "high")) for k in keys]
    return found.select("check_name", "failed", *ends)


def observed_checks(names: Sequence[str]) -> list[Column]:
    """The rows of a checked frame, those that fail any check and those that fail each, to be observed as it is written."""
    each = [F.count_if(F.array_contains(FAILED, n)).alias(f"failed_{i}") for i, n in enumerate(names)]
    return [F.count(F.lit(1)).alias("checked"), F.count_if(F.size(FAILED) > 0).alias("rows"), *each]


def missing_required(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Missing values per required column, counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing")) for c in required])
    return counts.select(F.inline(pairs))


def declare_checks(spark: SparkSession, table: str, checks: Mapping[str, str]) -> list[str]:
    """Store checks as table properties; a name that is already there is left as it is."""
    known = read_checks(spark, table)
    added = [name for name in checks if name not in known]
    texts = {name: checks[name].replace("\\", "\\\\").replace("'", "\\'") for name in added}
    if texts:
        properties = ", ".join(f"'{PROPERTY_PREFIX}{name}' = '{text}'" for name, text in texts.items())
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({properties})")
    return added


def read_checks(spark: SparkSession, table: str) -> dict[str, str]:
    """The checks stored with a table."""
    rows = (
        spark.sql(f"SHOW TBLPROPERTIES {table}")
        .filter(F.col("key").startswith(PROPERTY_PREFIX))
        .collect()
    )
    return {r["key"].removeprefix(PROPERTY_PREFIX): r["value"] for r in rows}
