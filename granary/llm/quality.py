"""Quality classifier: Naive Bayes support vectors.

A text is a set of n-gram indicators over its white-space separated tokens:
one and two words; one, two and three token shapes (case, digits, marks); and
four flags in a row that say whether a token repeats the one before. Each
indicator is scaled by its class log-count ratio, the vector is scaled to
length one, and a linear hinge-loss model is fitted by dual coordinate descent.
A logistic fit over margins of texts that the model has not seen (two halves,
each measured by the other's model) gives the score.

The classifier is fitted on a bounded sample, at most ``per_class`` labelled
documents of each class and ``MOST_GRAMS`` indicators that at least
``LEAST_DOCS`` of them have; indicators are counted in Spark. Labels of the
held-out fold are never read, and language, source and id are no inputs.

Edge cases: NULL text counts as empty; a text without known indicators gets
the score of the bias alone. Without labels of both classes nothing is learnt:
each score is 0, and no row is dropped for it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.common import keep_only, plain_names, whole_text, with_names
from granary.llm.labelled import fit_logistic, logistic

PER_CLASS = 2000
LEAST_DOCS, MOST_GRAMS = 5, 200_000
COST, ROUNDS = 1.0, 30
KNOWN_TOKENS = 400_000
MARKS = re.compile(r"[^\w\s]+")
STEP = np.uint64(0x9E3779B97F4A7C15)
DIRECTORY_BITS = 20


def shape(token: str) -> str:
    """Letter case, digits and marks of a token, each run cut to two characters."""
    letters = [c for c in token if c.isalpha()]
    if not letters:
        kind = "9" if any(c.isdigit() for c in token) else ""
    elif all(c.isupper() for c in letters):
        kind = "X" if len(letters) > 1 else "A"
    else:
        kind = "Xx" if letters[0].isupper() else "x"
    return f"{kind} {' '.join(run[:2] for run in MARKS.findall(token)[:4])}"


def word(token: str) -> str:
    return MARKS.sub("", token.lower())


class Tokens:
    """Hashes of the word and the shape of each token, worked out once per token."""

    def __init__(self) -> None:
        self.places: dict[str, int] = {}
        self.words = np.zeros(1024, dtype=np.uint64)
        self.shapes = np.zeros(1024, dtype=np.uint64)

    def find(self, tokens: list[str]) -> np.ndarray:
        if len(self.places) > KNOWN_TOKENS:
            self.places.clear()
        places = self.places
        for token in set(tokens).difference(places):
            at = places[token] = len(places)
            if at == len(self.words):
                self.words, self.shapes = (np.concatenate([a, np.zeros_like(a)]) for a in (self.words, self.shapes))
            self.words[at] = xxhash.xxh64_intdigest(word(token), 1)
            self.shapes[at] = xxhash.xxh64_intdigest(shape(token), 2)
        return np.fromiter(map(places.__getitem__, tokens), dtype=np.int64, count=len(tokens))


def combine(parts: list[np.ndarray], kind: int) -> np.ndarray:
    """One hash per n-gram; the top bits are mixed, as the lookup directory uses them."""
    total = np.full(len(parts[0]), kind, dtype=np.uint64)
    for part in parts:
        total = (total ^ part) * STEP
        total ^= total >> np.uint64(29)
    return total * STEP


def indicators(tokens: Tokens, text: str) -> np.ndarray:
    """Hashes of the n-grams of a text, repeats included."""
    found = text.split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    places = tokens.find(found)
    words, shapes = tokens.words[places], tokens.shapes[places]
    again = np.zeros(len(places), dtype=np.uint64)
    again[1:] = places[1:] == places[:-1]
    n = len(places)
    grams = [combine([words], 1), combine([shapes], 2)]
    for size, source, kind in ((2, words, 3), (2, shapes, 4), (3, shapes, 5), (4, again, 6)):
        if n >= size:
            grams.append(combine([source[i : n - size + 1 + i] for i in range(size)], kind))
    return np.concatenate(grams)


@dataclass
class NaiveBayesSvm:
    """Known n-grams in hash order with their ratios and weights, and the calibration."""

    grams: np.ndarray
    ratios: np.ndarray
    weights: np.ndarray  # one per gram and the bias
    calibration: np.ndarray | None = None
    tokens: Tokens = field(default_factory=Tokens)
    directory: np.ndarray | None = None

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Places of the known n-grams among the hashes, each once."""
        if not len(self.grams):
            return np.zeros(0, dtype=np.int64)
        shift = np.uint64(64 - DIRECTORY_BITS)
        if self.directory is None:
            self.directory = np.searchsorted(self.grams >> shift, np.arange((1 << DIRECTORY_BITS) + 1))
        top = (hashes >> shift).astype(np.int64)
        at, end = self.directory[top], self.directory[top + 1]
        out = []
        while len(at):
            left = at < end
            at, end, hashes = at[left], end[left], hashes[left]
            same = self.grams[at] == hashes
            out.append(at[same])
            at, end, hashes = at[~same] + 1, end[~same], hashes[~same]
        return np.unique(np.concatenate(out)) if out else np.zeros(0, dtype=np.int64)

    def margin(self, text: str) -> float:
        places = self.find(indicators(self.tokens, text))
        if not len(places):
            return float(self.weights[-1])
        values = self.ratios[places]
        return float(values @ self.weights[places] / max(1e-9, np.sqrt(values @ values)) + self.weights[-1])

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.calibration is None:
            return np.zeros(len(texts))
        margins = np.array([self.margin(t) for t in texts])
        return logistic(margins * self.calibration[0] + self.calibration[1])


def dual_coordinate_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int) -> np.ndarray:
    """Weights (and bias, last) of a linear hinge-loss model with a quadratic penalty.

    One dual variable per row, kept between 0 and its cost, is moved to its
    best value at a time. Classes of different size have the same total cost.
    """
    w = np.zeros(size + 1)
    sign = np.where(y > 0, 1.0, -1.0)
    share = {s: max(1, (sign == s).sum()) for s in (-1.0, 1.0)}
    cost = np.array([COST * len(y) / (2 * share[s]) for s in sign])
    alpha = np.zeros(len(rows))
    squares = np.array([v @ v + 1.0 for _, v in rows])
    order = np.random.default_rng(7)
    for _ in range(ROUNDS):
        largest = 0.0
        for i in order.permutation(len(rows)):
            places, values = rows[i]
            gradient = sign[i] * (w[places] @ values + w[-1]) - 1
            moved = min(max(alpha[i] - gradient / squares[i], 0.0), cost[i])
            step = moved - alpha[i]
            if step:
                w[places] += step * sign[i] * values
                w[-1] += step * sign[i]
                alpha[i] = moved
                largest = max(largest, abs(step))
        if largest < 1e-3:
            break
    return w


def gram_documents(sample: DataFrame) -> pd.DataFrame:
    """Documents per class and half that have each n-gram, the most frequent ``MOST_GRAMS`` of them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        for batch in batches:
            found = [np.unique(indicators(tokens, t)) for t in batch.column("text").to_pylist()]
            part = 2 * batch.column("y").to_numpy() + batch.column("half").to_numpy()
            parts = np.repeat(part, [len(f) for f in found]).astype(np.int32)
            grams = np.concatenate([*found, np.zeros(0, dtype=np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(parts)], names=["gram", "part"])

    counted = sample.mapInArrow(count, "gram bigint, part int")
    per_part = [F.count_if(F.col("part") == p).alias(f"n{p}") for p in range(4)]
    frequent = counted.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), *per_part).filter(F.col("n") >= LEAST_DOCS)
    return frequent.orderBy(F.desc("n"), "gram").limit(MOST_GRAMS).toPandas()


def ratios_of(counts: pd.DataFrame, parts: tuple[int, ...], documents: dict[int, int]) -> np.ndarray:
    """Log ratio of the smoothed shares of documents that have each n-gram."""
    shares = []
    for y in (0, 1):
        own = [p for p in parts if p // 2 == y]
        seen = sum((counts[f"n{p}"].to_numpy() for p in own), start=np.zeros(len(counts)))
        shares.append((seen + 1) / (sum(documents.get(p, 0) for p in own) + 2))
    return np.log(shares[1] / shares[0])


def sample_rows(sample: DataFrame, grams: np.ndarray) -> pd.DataFrame:
    """Label, half and places of known n-grams of each sampled text."""
    shipped = sample.sparkSession.sparkContext.broadcast(NaiveBayesSvm(grams, np.zeros(0), np.zeros(0)))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        for batch in batches:
            places = [model.find(indicators(model.tokens, t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), batch.column("half"), pa.array(places, pa.list_(pa.int32()))],
                names=["y", "half", "places"],
            )

    return sample.mapInArrow(find, "y int, half int, places array<int>").toPandas()


def train(sample: DataFrame) -> NaiveBayesSvm:
    """Fit on a sample with ``y``, ``half`` and ``text``; everything collected is bounded by the sample."""
    sample = sample.select("y", "half", "text")
    counts = gram_documents(sample)
    order = np.argsort(counts["gram"].to_numpy().view(np.uint64))
    counts = counts.iloc[order].reset_index(drop=True)
    grams = counts["gram"].to_numpy().astype(np.int64).view(np.uint64)
    rows = sample_rows(sample, grams)
    y, half = rows["y"].to_numpy(), rows["half"].to_numpy()
    if len(set(y)) < 2:
        return NaiveBayesSvm(grams, np.zeros(len(grams)), np.zeros(len(grams) + 1))
    documents = (2 * rows["y"] + rows["half"]).value_counts().to_dict()

    def fit(chosen: np.ndarray, parts: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
        ratios = ratios_of(counts, parts, documents)
        scaled = [scale(rows["places"][i], ratios) for i in np.flatnonzero(chosen)]
        return ratios, dual_coordinate_descent(scaled, y[chosen], len(grams))

    margins = np.zeros(len(y))
    for k in (0, 1):
        ratios, w = fit(half == k, (k, 2 + k))
        for i in np.flatnonzero(half != k):
            places, values = scale(rows["places"][i], ratios)
            margins[i] = w[places] @ values + w[-1]
    ratios, w = fit(y >= 0, (0, 1, 2, 3))
    return NaiveBayesSvm(grams, ratios, w, fit_logistic(margins[:, None], y.astype(float)))


def scale(places: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    places = np.asarray(places, dtype=np.int64)
    values = ratios[places]
    return places, values / max(1e-9, np.sqrt(values @ values))


def score(spark: SparkSession, model: NaiveBayesSvm, text: Column) -> Column:
    """The probability that a text is of good quality. The model is broadcast; ``MOST_GRAMS`` bounds its size."""
    shipped = spark.sparkContext.broadcast(model)

    def of_batch(texts: pd.Series) -> pd.Series:
        keep_only("quality")
        return pd.Series(shipped.value.scores(texts.tolist()))

    return F.pandas_udf(of_batch, "double")(text)


def quality(
    docs: DataFrame,
    model: NaiveBayesSvm,
    held_out: Column,
    threshold: float,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    scored = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        held_out.alias("held_out"),
        score(docs.sparkSession, model, whole_text(text)).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, model: NaiveBayesSvm, threshold: float, text: str = "text") -> DataFrame:
    """The rows whose text the classifier accepts, with all their columns; all rows if it was never calibrated."""
    if model.calibration is None:
        return docs
    plain, names = plain_names(docs)
    scored = plain.withColumn("_score", score(docs.sparkSession, model, whole_text(names[text])))
    return with_names(scored.filter(F.col("_score") >= threshold), names)
