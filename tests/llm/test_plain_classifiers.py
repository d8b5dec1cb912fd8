"""The classifiers against versions from plain dictionaries and loops."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from granary.llm import quality, toxicity
from granary.llm.labelled import fit_logistic

SAMPLE = "y int, half int, text string"


def sample_of(documents):
    """Sampled rows of both classes and halves: texts, with and without some words that tell them apart."""
    rnd = random.Random(2)
    rows = []
    for k, (_, text) in enumerate(documents[:160]):
        words = (text or "").split()[:120]
        y = k % 2
        for _ in range(rnd.randint(0, 4)):
            words.insert(rnd.randint(0, len(words)), rnd.choice(["BUY", "now!!", "click"] if y else ["indeed", "Hence,", "thus"]))
        rows.append((y, k // 2 % 2, " ".join(words)))
    return rows


# Quality


def grams_of(text):
    tokens = text.split()
    words, shapes = [quality.word(t) for t in tokens], [quality.shape(t) for t in tokens]
    again = [i > 0 and t == tokens[i - 1] for i, t in enumerate(tokens)]
    out = set()
    for kind, size, source in (("w", 1, words), ("s", 1, shapes), ("w", 2, words), ("s", 2, shapes), ("s", 3, shapes), ("r", 4, again)):
        out |= {(kind, *source[i : i + size]) for i in range(len(tokens) - size + 1)}
    return out


class PlainQuality:
    def __init__(self, rows):
        self.found = [grams_of(t) for *_, t in rows]
        n = Counter(g for f in self.found for g in f)
        self.known = {g for g in n if n[g] >= quality.LEAST_DOCS}
        y, half = [r[0] for r in rows], [r[1] for r in rows]
        margins = [0.0] * len(rows)
        for k in (0, 1):
            self.fit([i for i in range(len(rows)) if half[i] == k], y)
            for i in range(len(rows)):
                if half[i] != k:
                    margins[i] = self.margin(self.found[i])
        self.fit(list(range(len(rows))), y)
        self.a, self.b = fit_logistic(np.array(margins)[:, None], np.array(y, dtype=float))

    def fit(self, chosen, y):
        docs = Counter(y[i] for i in chosen)
        seen = {c: Counter(g for i in chosen if y[i] == c for g in self.found[i]) for c in (0, 1)}
        share = lambda c, g: (seen[c][g] + 1) / (docs[c] + 2)
        self.ratio = {g: math.log(share(1, g) / share(0, g)) for g in self.known}
        self.w, self.bias = defaultdict(float), 0.0
        rows = [self.scaled(self.found[i]) for i in chosen]
        sign = [1 if y[i] else -1 for i in chosen]
        cost = [quality.COST * len(rows) / (2 * sign.count(s)) for s in sign]
        alpha, order = [0.0] * len(rows), np.random.default_rng(7)
        for _ in range(quality.ROUNDS):
            largest = 0.0
            for i in order.permutation(len(rows)):
                gradient = sign[i] * (sum(self.w[g] * v for g, v in rows[i].items()) + self.bias) - 1
                square = sum(v * v for v in rows[i].values()) + 1
                moved = min(max(alpha[i] - gradient / square, 0), cost[i])
                step, alpha[i] = moved - alpha[i], moved
                for g, v in rows[i].items():
                    self.w[g] += step * sign[i] * v
                self.bias += step * sign[i]
                largest = max(largest, abs(step))
            if largest < 1e-3:
                break

    def scaled(self, grams):
        own = {g: self.ratio[g] for g in grams & self.known}
        length = max(1e-9, math.sqrt(sum(v * v for v in own.values())))
        return {g: v / length for g, v in own.items()}

    def margin(self, grams):
        return sum(self.w[g] * v for g, v in self.scaled(grams).items()) + self.bias

    def score(self, text):
        return 1 / (1 + math.exp(-(self.margin(grams_of(text)) * self.a + self.b)))


def test_quality_equals_plain_loops(docs, documents):
    rows = sample_of(documents)
    model = quality.train(docs(rows, SAMPLE).coalesce(1))
    texts = [t or "" for _, t in documents] + ["", "BUY now!!", "a a a a a", "İß 9-9"]
    plain = PlainQuality(rows)
    assert model.scores(texts) == pytest.approx([plain.score(t) for t in texts], abs=1e-9)
    assert plain.score("BUY now!! click") != pytest.approx(plain.score("indeed Hence, thus"), abs=0.05)


# Toxicity


def plain_grams(word):
    whole = "\x02" * 7 + word + "\x03"
    return [whole[i : i + 8] for i in range(len(word) + 1)]


class PlainToxicity:
    """Kneser-Ney with dictionaries: counts at the top order, continuation counts below."""

    def __init__(self, rows, parts):
        self.n = [Counter(), Counter()]
        for y, half, text in rows:
            if (y, half) in parts:
                for w in re.findall(r"\w+", text.lower()):
                    self.n[y].update(plain_grams(w))
        self.levels, current = {}, set(self.n[0]) | set(self.n[1])
        for size in range(7, 0, -1):
            self.levels[size] = Counter(g[1:] for g in current)
            current = set(self.levels[size])
        self.total, self.kinds = {}, {}
        for size, counts in self.levels.items():
            self.total[size], self.kinds[size] = Counter(), Counter()
            for g, n in counts.items():
                self.total[size][g[:-1]] += n
                self.kinds[size][g[:-1]] += 1
        self.sums = [Counter(), Counter()]
        self.held = [defaultdict(float), defaultdict(float)]
        for y in (0, 1):
            for g, n in self.n[y].items():
                self.sums[y][g[:-1]] += n
                self.held[y][g[:-1]] += toxicity.DISCOUNTS[min(n, 3)]

    def shared(self, g):
        if not g:
            return 1 / toxicity.ALPHABET
        size, context = len(g), g[:-1]
        d, total = toxicity.SHARED_DISCOUNT, self.total[size][context]
        return (self.levels[size][g] - d) / total + d * self.kinds[size][context] / total * self.shared(g[1:])

    def log(self, y, g):
        """Known grams through the shared model; of other letters only what the class gives back, which is shared too."""
        total = self.sums[y][g[:-1]]
        backoff = self.held[y][g[:-1]] / total if total else 1.0
        if g not in self.n[0] and g not in self.n[1]:
            return math.log(backoff)
        own = self.n[y][g]
        seen = (own - toxicity.DISCOUNTS[min(own, 3)]) / total if total else 0.0
        return math.log(seen + backoff * self.shared(g[1:]))

    def evidence(self, word):
        return sum(self.log(1, g) - self.log(0, g) for g in plain_grams(word))

    def features(self, text):
        v = [self.evidence(w) for w in re.findall(r"\w+", text.lower())]
        if not v:
            return [0.0, 0.0, 0.0]
        telling = sum(x for x in v if x > toxicity.TELLING)
        return [sum(v) / len(v), math.log1p(50 * telling / len(v)), min(max(v), 30.0) / 10]


def test_toxicity_equals_plain_dictionaries(docs, documents):
    rnd = random.Random(3)
    rows = [(y, h, t + " you scum loser" * rnd.randint(0, 2) * y) for y, h, t in sample_of(documents)]
    halves = [PlainToxicity(rows, [(0, k), (1, k)]) for k in (0, 1)]
    crossed = np.array([halves[1 - h].features(t) for _, h, t in rows])
    w = fit_logistic(crossed, np.array([float(y) for y, *_ in rows]))
    plain = PlainToxicity(rows, [(y, h) for y in (0, 1) for h in (0, 1)])
    model = toxicity.train(docs(rows, SAMPLE).coalesce(1))
    texts = [t or "" for _, t in documents[:120]] + ["", "scum", "zzz you scumm"]
    want = [1 / (1 + math.exp(-(np.dot(plain.features(t), w[:-1]) + w[-1]))) for t in texts]
    assert model.scores(texts) == pytest.approx(want, abs=1e-5)  # evidence is kept in 32 bits
    assert max(want) - min(want) > 0.3
