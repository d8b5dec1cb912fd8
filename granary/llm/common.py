"""Helpers that the text operators share."""

from __future__ import annotations

import os
from collections.abc import Callable
from itertools import islice
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.session import apply_settings, scratch_path, scratch_root

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Texts differ a lot in length, so Arrow batches are bounded by bytes as well as by rows.
ARROW_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings, scratch folder and import path that the operators count on."""
    apply_settings(spark)
    scratch_root(spark)
    for key, value in ARROW_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if PACKAGE_ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *filter(None, paths)])
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts lineage, and fixes generated values (row numbers above all), so that
    work redone after a lost executor sees the same rows.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def whole_text(text: str) -> Column:
    """The text column; NULL counts as empty."""
    return F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))


def plain_names(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The columns under names that cannot clash (``c0, c1, ...``), and these names by the old ones."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), names


def with_names(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    return rows.select(*[F.col(n).alias(c) for c, n in names.items()])


def no_join_names(df: DataFrame, *taken: str) -> None:
    """Raise on columns that would clash with an operator's own working columns."""
    clash = [c for c in df.columns if c.lower() in {t.lower() for t in taken}]
    if clash:
        raise ValueError(f"columns {clash} are used by the operator itself; rename them first")


def forget_half(known: dict[Any, Any]) -> None:
    """Drop the older half of what a worker remembers."""
    for key in list(islice(known, len(known) // 2)):
        del known[key]


KEPT: dict[str, Callable[[], None]] = {}  # by operator: drops what it keeps in this worker between tasks


def keep_only(operator: str, drop: Callable[[], None] | None = None) -> None:
    """Drop what other operators keep in this worker, which a session uses again for all of its stages."""
    for other in [o for o in KEPT if o != operator]:
        KEPT.pop(other)()
    if drop:
        KEPT[operator] = drop
