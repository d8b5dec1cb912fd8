import random
import zlib
from collections import Counter

import duckdb
import pytest

from granary.llm import spelling
from granary.llm.queries import LLM_ORACLES, MISSPELL, op12_spelling_variants

SF = "/root/testdata/sf0.001"
WORD = "word string, n bigint"


def near(a, b):
    """By definition: one deleted, inserted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(counts):
    out = set()
    form = {}
    for w, n in counts.items():
        found = [x for x in counts if near(w, x)]
        top = min(found, key=lambda x: (-counts[x], x), default=None)
        form[w] = top if top is not None and counts[top] >= 2 * n else None
        out.add((w, form[w], n, len(found), counts[form[w]] if form[w] else None))
    root = lambda w: root(form[w]) if form[w] else w
    return {(w, f, root(w), *rest) for w, f, *rest in out}


def plain_counts(rows, misspell):
    total = Counter()
    for key, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words, run = [], ""
        for c in low + " ":
            if "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c
            else:
                words += [run] if run else []
                run = ""
        for w in words:
            h = zlib.crc32(f"{'' if key is None else key}:{w}".encode())
            if misspell and h % misspell == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            total[w] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


@pytest.mark.parametrize("letters", ["ab", "abé", "etaozàæ÷q"])
def test_equals_all_pairs(docs, monkeypatch, letters):
    monkeypatch.setattr(spelling, "TOGETHER", 7)
    rnd = random.Random(len(letters))
    counts = {"".join(rnd.choices(letters, k=rnd.randint(5, 8))): rnd.choice([3, 4, 6, 9, 9, 30, 80]) for _ in range(250)}
    counts |= {"long" * 700: 5, "long" * 700 + "g": 20, "zz": 3, "x": 7, "xy": 1}
    for tile in (3, 2048):
        got = [tuple(r) for r in spelling.variants(docs(list(counts.items()), WORD), tile=tile).collect()]
        assert len(got) == len(counts) and set(got) == brute(counts)


def test_counts_equal_a_plain_scan(docs, documents, odd_rows):
    rows = documents[:80] + odd_rows + [(9, "ABCÀÉ abcÀÉ abcàé ÀÉÿ×÷ straße x_yzzzz1yzzzz"), (9, "abcàé"), (9, "abcàé")]
    for misspell in (None, 3, 97):
        made = spelling.count_words(docs(rows), misspell=misspell).collect()
        assert {r.word: r.n for r in made} == plain_counts(rows, misspell)
        assert len(made) == len({r.word for r in made})


def test_query_equals_brute_force(llm, documents):
    got = {tuple(r) for r in op12_spelling_variants(llm, SF).collect()}
    counts = plain_counts(documents, MISSPELL)
    assert {(w, n) for w, _, _, n, _, _ in got} == set(counts.items())
    duckdb.sql(f"CREATE OR REPLACE TEMP VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert got == set(duckdb.sql(LLM_ORACLES["op12_spelling_variants"]).fetchall())
    some = set(random.Random(4).sample(sorted(counts), 60))
    for w, form, _, n, n_near, form_n in got:
        if w in some:
            found = [x for x in counts if abs(len(x) - len(w)) < 2 and near(w, x)]
            assert n_near == len(found)
            top = min(found, key=lambda x: (-counts[x], x), default=None)
            assert form == (top if top and counts[top] >= 2 * n else None)


def test_empty_and_clashing_columns(llm, docs):
    assert spelling.variants(spelling.count_words(docs([]))).collect() == []
    extra = docs([(1, "spelling spelling spelling speling")]).selectExpr("*", "1 AS key", "2 AS word", "3 AS n")
    assert [tuple(r) for r in spelling.variants(spelling.count_words(extra)).collect()] == [
        ("spelling", None, "spelling", 3, 0, None)]


def test_long_chains_end_at_their_root(docs):
    words = [("a" * 5 + "b" * k, 3 * 2**k) for k in range(20)]
    got = {r.word: (r.form, r.root) for r in spelling.variants(docs(words, WORD)).collect()}
    assert all(got[w][1] == words[-1][0] for w, _ in words)
    assert [got[w][0] for w, _ in words] == [w for w, _ in words[1:]] + [None]
