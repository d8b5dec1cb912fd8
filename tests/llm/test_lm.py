import collections
import math
import zlib

import pytest
from pyspark.sql import functions as F

from granary.llm import lm
from granary.llm.common import fold


def tokens(text):
    return [*(text or "").encode().lower().split(), 0]


class Plain:
    """The same model from plain dictionaries."""

    def __init__(self, texts):
        texts = [tokens(t) for t in texts]
        self.words = collections.Counter(w for x in texts for w in x)
        self.pairs = collections.Counter(p for x in texts for p in zip([None, *x], x))
        self.kinds = collections.Counter(w for _, w in self.pairs)
        count = lambda c: [sum(n == k for n in c.values()) for k in (1, 2, 3, 4)]
        self.d, self.e = lm.discounts(count(self.pairs)), lm.discounts(count(self.kinds))
        self.share = sum(self.e[min(n, 3)] for n in self.kinds.values()) / len(self.pairs) if self.pairs else 1
        self.total, self.given = collections.Counter(), collections.Counter()
        for (v, _), n in self.pairs.items():
            self.total[v] += n
            self.given[v] += self.d[min(n, 3)]

    def word(self, w):
        own = max(self.kinds[w] - self.e[min(self.kinds[w], 3)], 0) / len(self.pairs) if self.pairs else 0
        return own + self.share / (len(self.words) + 1)

    def pair(self, w, v):
        if not self.total[v]:
            return self.word(w)
        n = self.pairs[v, w]
        return max(n - self.d[min(n, 3)], 0) / self.total[v] + self.given[v] / self.total[v] * self.word(w)

    def score(self, text):
        x = tokens(text)
        n, v = self.words.total(), len(self.words)
        base = sum(math.log10((self.words[w] + 0.5) / (n + 0.5 * (v + 1))) for w in x)
        return len(x), sum(self.words[w] > 0 for w in x), n, base, sum(math.log10(self.pair(w, u)) for u, w in zip([None, *x], x))


def check(rows, got, plain):
    for i, text in rows:
        want = plain.score(text)
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[:3]
        assert (r.base_score, r.score) == pytest.approx(want[3:], rel=1e-9, abs=1e-9)


def test_scores_equal_plain_counts(docs, documents, odd_rows):
    rows = documents[:120] + [(1000 + i, t) for i, (_, t) in enumerate(odd_rows)]
    held_out = fold(F.col("doc_id"), 5) == 1
    df = docs(rows)
    got = {r.doc_id: r for r in lm.score(df, lm.train(df.filter(~held_out)), held_out).collect()}
    plain = Plain([t for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1])
    check(rows, got, plain)
    for v in (b"the", None, b"never seen"):
        unseen = plain.pair("unknown", v)
        assert sum(plain.pair(w, v) for w in plain.words) + unseen == pytest.approx(1)


def test_no_training_texts_and_empty_tables(docs):
    rows = [(1, "a b"), (2, None)]
    got = {r.doc_id: r for r in lm.score(docs(rows), lm.train(docs([])), F.lit(True)).collect()}
    check(rows, got, Plain([]))
    assert lm.score(docs([]), lm.train(docs(rows)), F.lit(False)).collect() == []


def test_one_frequent_word_is_spread_over_the_slices(docs):
    rows = [(i, " ".join(f"the w{i}x{k}" for k in range(40))) for i in range(40)]
    model = lm.train(docs(rows))
    assert lm.short(lm.np.array([lm.xxhash.xxh64_intdigest(b"the")], dtype=lm.np.uint64))[0] in model.frequent
    got = {r.doc_id: r for r in lm.score(docs(rows), model, F.lit(False)).collect()}
    check(rows, got, Plain([t for _, t in rows]))
