"""Bounded samples of labelled rows, and calibration of scores."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import fold, whole_text


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    folds: int,
    held_out: int,
    per_class: int,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``y, half, text`` of at most ``per_class`` labelled documents of each class.

    Documents of the held-out fold are left out. The sample is the rows whose
    hashed ids come first, so it is the same in each run. A document labelled
    more than once counts with its highest label, and of rows with one id one is
    taken, whatever their number; rows without label or id are left out. The
    chosen ids, 2 x ``per_class`` at most, are broadcast.
    """
    known = (
        labels.select(F.col(doc_id).alias("doc_id"), F.col(f"`{label}`").cast("int").alias("y"))
        .filter(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), folds) != held_out))
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
    )
    rank = F.xxhash64(F.col("doc_id").cast("string"))
    present = known.join(docs.select(F.col(f"`{doc_id}`").alias("doc_id")).distinct(), "doc_id", "left_semi")
    chosen = [present.filter(F.col("y") == y).orderBy(rank, "doc_id").limit(per_class) for y in (0, 1)]
    rows = chosen[0].unionByName(chosen[1]).select("doc_id", "y", F.pmod(rank, F.lit(2)).cast("int").alias("half"))
    texts = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), whole_text(text).alias("text"))
    # One row per id, combined in each task, so that what is collected later is bounded as said.
    chosen_texts = texts.join(F.broadcast(rows), "doc_id").groupBy("doc_id", "y", "half").agg(F.min("text").alias("text"))
    return chosen_texts.select("y", "half", "text")


def fit_logistic(features: np.ndarray, y: np.ndarray, ridge: float = 1e-2, balanced: bool = True) -> np.ndarray:
    """Weights and bias of a logistic regression, by Newton steps."""
    x = np.hstack([features, np.ones((len(features), 1))])
    share = np.array([max(1, (y == k).sum()) for k in (0, 1)])
    weight = (len(y) / (2 * share))[y.astype(int)] if balanced else np.ones(len(y))
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    penalty[-1, -1] = 1e-6
    for _ in range(50):
        p = logistic(x @ w)
        gradient = x.T @ (weight * (p - y)) + penalty @ w
        curvature = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + penalty
        step = np.linalg.solve(curvature, gradient)
        size = np.abs(step).max()
        w -= step * min(1.0, 4.0 / max(size, 1e-9))
        if size < 1e-6:
            break
    return w


def logistic(z: np.ndarray | float | Sequence[float]) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))
