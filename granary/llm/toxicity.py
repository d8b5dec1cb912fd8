"""Toxicity by class-conditional Kneser-Ney models.

Toxic and ordinary words are modelled letter by letter. Each class has its own
counts of letters after the seven letters before them; below that, both back
off to one interpolated Kneser-Ney model over the counts of both, so a rare
word is judged by what the classes share and only known expressions tell them
apart. A word's evidence is the difference of its two log-likelihoods.

A text is judged by three length-normalised differences: over all its words,
over its telling words (evidence above ``TELLING``), and of its most telling
word. A logistic fit over texts that the models have not seen (two halves,
each scored by the other's models) turns them into a probability.

The classifier is fitted on a bounded sample of labelled documents, at most
``per_class`` of each class; letter counts are taken in Spark. Labels of the
held-out fold are never read, and language, source and id are no inputs.

Edge cases: NULL text counts as empty; a text without words has no evidence
and gets the score of zero evidence. Without labels of both classes each score
is 0.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.common import forget_half, whole_text
from granary.llm.labelled import fit_logistic, logistic

ORDER = 8  # letters of a gram, the last of which is predicted
PER_CLASS = 3000
DISCOUNTS = np.array([0.0, 0.85, 1.3, 1.6])  # of a class's counts of 0, 1, 2 and more
SHARED_DISCOUNT = 0.75
ALPHABET = 300.0
TELLING = 3.0
START, STOP = "\x02", "\x03"
WORD = re.compile(r"\w+")
KNOWN_WORDS = 500_000
STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def padded(word: str) -> str:
    return START * (ORDER - 1) + word + STOP


def hash_windows(codes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each stretch of ``width`` code points."""
    n = len(codes) - width + 1
    total = np.zeros(n, dtype=np.uint64)
    for i in range(width):
        total = total * STEP + codes[i : i + n]
    return total


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)


@dataclass
class Evidence:
    """Sorted hash arrays: evidence of known grams, and of any other letter after a known context."""

    grams: np.ndarray
    gram_values: np.ndarray
    contexts: np.ndarray
    context_values: np.ndarray
    weights: np.ndarray | None = None
    known: dict[str, float] = field(default_factory=dict)

    def learn(self, words: list[str]) -> None:
        if not words:
            return
        codes = codes_of("".join(map(padded, words)))
        lengths = np.array([len(w) for w in words])
        firsts = np.concatenate([[0], np.cumsum(lengths + ORDER)[:-1]])
        # A word of n letters has n + 1 grams, which start at its first n + 1 places.
        here = np.repeat(firsts, lengths + 1) + np.concatenate([np.arange(n + 1) for n in lengths])
        values = look_up(hash_windows(codes, ORDER)[here], self.grams, self.gram_values, np.nan)
        other = look_up(hash_windows(codes, ORDER - 1)[here], self.contexts, self.context_values, 0.0)
        values = np.where(np.isnan(values), other, values)
        ends = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
        self.known.update(zip(words, np.add.reduceat(values, ends).tolist()))

    def features(self, texts: list[str]) -> np.ndarray:
        found = [words_of(t) for t in texts]
        every = set().union(*found) if found else set()
        new = [w for w in every if w not in self.known]
        if len(new) + len(self.known) > KNOWN_WORDS:
            forget_half(self.known)
            new = [w for w in every if w not in self.known]
        self.learn(new)
        out = np.zeros((len(texts), 3))
        for row, words in zip(out, found):
            if not words:
                continue
            v = np.fromiter(map(self.known.__getitem__, words), dtype=float, count=len(words))
            row[:] = v.mean(), np.log1p(50 * v[v > TELLING].sum() / len(v)), min(v.max(), 30.0) / 10
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(texts))
        return logistic(self.features(texts) @ self.weights[:-1] + self.weights[-1])


def look_up(keys: np.ndarray, known: np.ndarray, values: np.ndarray, otherwise: float) -> np.ndarray:
    if not len(known):
        return np.full(len(keys), otherwise)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, values[at], otherwise)


@dataclass
class Grams:
    """Different grams as rows of code points, and their counts per class and half."""

    codes: np.ndarray
    n: np.ndarray


def gram_counts(sample: DataFrame) -> Grams:
    """Counts of letter grams per class and half, counted in Spark; bounded as the sample is."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups: dict[tuple[int, int], Counter[str]] = {}
            for y, half, text in zip(*(batch.column(c).to_pylist() for c in ("y", "half", "text"))):
                groups.setdefault((y, half), Counter()).update(words_of(text))
            for (y, half), words in groups.items():
                grams: Counter[str] = Counter()
                for word, n in words.items():
                    whole = padded(word)
                    for i in range(len(word) + 1):
                        grams[whole[i : i + ORDER]] += n
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(grams), pa.string()),
                        pa.array([2 * y + half] * len(grams), pa.int32()),
                        pa.array(list(grams.values()), pa.int64()),
                    ],
                    names=["gram", "part", "n"],
                )

    counted = sample.mapInArrow(count, "gram string, part int, n bigint")
    parts = [F.sum(F.when(F.col("part") == p, F.col("n")).otherwise(0)).alias(f"n{p}") for p in range(4)]
    found = counted.groupBy("gram").agg(*parts).toArrow()
    letters = [codes_of(b"".join(c.cast(pa.binary()).to_pylist()).decode()) for c in found["gram"].chunks]
    codes = np.concatenate([*letters, np.zeros(0, dtype=np.uint64)]).astype(np.uint32).reshape(-1, ORDER)
    return Grams(codes, np.array([found[f"n{p}"].to_numpy() for p in range(4)]))


def shared_model(codes: np.ndarray) -> np.ndarray:
    """Interpolated Kneser-Ney probability of each gram's last letter after all but the first.

    Level by level, a shorter gram counts in how many different longer ones it occurs.
    """
    levels, current = [], codes
    for _ in range(ORDER - 1):
        shorter = current[:, 1:]
        _, first, back, n = np.unique(
            hash_rows(shorter), return_index=True, return_inverse=True, return_counts=True
        )
        current = shorter[first]
        levels.append((current, n, back))
    lower = np.array([1 / ALPHABET])
    above = np.zeros(len(levels[-1][1]), dtype=np.int64)
    for grams, n, back in reversed(levels):
        _, context = np.unique(hash_rows(grams[:, :-1]), return_inverse=True)
        total, kinds = np.bincount(context, n)[context], np.bincount(context)[context]
        lower = (n - SHARED_DISCOUNT) / total + SHARED_DISCOUNT * kinds / total * lower[above]
        above = back
    return lower[above]


def fit(counts: Grams, parts: tuple[int, ...]) -> Evidence:
    """Evidence of each gram from the counts of the given parts (2 x class + half)."""
    n = np.array([counts.n[[p for p in parts if p // 2 == y]].sum(axis=0) for y in (0, 1)])
    known = n.sum(axis=0) > 0
    codes, n = counts.codes[known], n[:, known]
    if not len(codes):
        nothing = np.zeros(0)
        return Evidence(nothing.astype(np.uint64), nothing, nothing.astype(np.uint64), nothing)
    shared = shared_model(codes)
    contexts, first, context = np.unique(hash_rows(codes[:, :-1]), return_index=True, return_inverse=True)
    logs, rest = [], []
    for own in n:
        discount = DISCOUNTS[np.minimum(own, 3)]
        total, held = np.bincount(context, own)[context], np.bincount(context, discount)[context]
        with np.errstate(divide="ignore", invalid="ignore"):
            backoff = np.where(total > 0, held / total, 1.0)
            seen = np.where(total > 0, (own - discount) / total, 0.0)
        logs.append(np.log(seen + backoff * shared))
        rest.append(np.log(backoff))
    grams = hash_rows(codes)
    order = np.argsort(grams)
    values, other = (logs[1] - logs[0]).astype(np.float32), (rest[1] - rest[0]).astype(np.float32)
    return Evidence(grams[order], values[order], contexts, other[first])


def hash_rows(codes: np.ndarray) -> np.ndarray:
    total = np.zeros(len(codes), dtype=np.uint64)
    for column in codes.T:
        total = total * STEP + column.astype(np.uint64)
    return total


def train(sample: DataFrame) -> Evidence:
    """Fit both classes' models and the calibration on a sample with ``y``, ``half`` and ``text``."""
    sample = sample.select("y", "half", "text")
    counts = gram_counts(sample)
    if not all(counts.n[2 * y : 2 * y + 2].sum() for y in (0, 1)):
        return fit(counts, ())
    halves = [fit(counts, (half, 2 + half)) for half in (0, 1)]
    crossed = features_of(sample, halves)
    model = fit(counts, (0, 1, 2, 3))
    model.weights = fit_logistic(crossed[:, 1:], crossed[:, 0])
    return model


def features_of(sample: DataFrame, halves: list[Evidence]) -> np.ndarray:
    """Label and features of the sample's texts, each scored by the other half's models."""
    models = sample.sparkSession.sparkContext.broadcast(halves)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            half, texts = batch.column("half").to_numpy(), batch.column("text").to_pylist()
            x = np.zeros((len(texts), 3))
            for k in (0, 1):
                own = np.flatnonzero(half != k)
                x[own] = models.value[k].features([texts[i] for i in own])
            yield pa.RecordBatch.from_arrays(
                [batch.column("y").cast(pa.float64()), *[pa.array(c) for c in x.T]], names=["y", "a", "b", "c"]
            )

    return sample.mapInArrow(measure, "y double, a double, b double, c double").toPandas().to_numpy()


def score(spark: SparkSession, model: Evidence, text: Column) -> Column:
    """The probability that a text is toxic. The model is broadcast; the sample bounds its size."""
    shipped = spark.sparkContext.broadcast(model)

    def of_batch(texts: pd.Series) -> pd.Series:
        return pd.Series(shipped.value.scores(texts.tolist()))

    return F.pandas_udf(of_batch, "double")(text)


def toxicity(
    docs: DataFrame, model: Evidence, held_out: Column, threshold: float, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    scored = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        held_out.alias("held_out"),
        score(docs.sparkSession, model, whole_text(text)).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
