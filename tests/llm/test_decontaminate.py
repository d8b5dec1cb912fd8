import random
import re
from itertools import combinations

import duckdb

from granary.llm import decontaminate as d

ITEM = "item_id bigint, text string"


def leaks_of(rows, items):
    tokens = lambda t: re.findall(r"\w+", (t or "").lower())
    out = set()
    for i, text in rows:
        words = tokens(text)
        for k, item in items:
            test = tokens(item)
            width = min(d.WINDOW, len(test))
            if not test or len(words) < width:
                continue
            for a in range(len(words) - width + 1):
                for b in range(len(test) - width + 1):
                    if sum(x == y for x, y in zip(words[a : a + width], test[b : b + width])) >= width - d.allowed(width):
                        out.add((i, k))
                        break
    return out


def found(df):
    return {(r.key, r.item) for r in df.collect()}


def test_masks_find_every_stretch():
    for size in range(d.LEAST_TOKENS, d.WINDOW + 1):
        spots = [{p + o for o, c in enumerate(m) if c == "1"} for m in d.MASKS for p in range(size - len(m) + 1)]
        for wrong in combinations(range(size), d.allowed(size)):
            assert any(not spot & set(wrong) for spot in spots)


def test_planted_passages(docs):
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(60)]
    items = [(k, " ".join(rnd.choices(words, k=n))) for k, n in enumerate([1, 2, 3, 4, 5, 6, 7, 8, 9, 13, 20, 30] * 3)]
    rows = []
    for i in range(150):
        text = rnd.choices(words, k=rnd.randint(0, 40))
        if i % 2:
            item = rnd.choice(items)[1].split()
            start = rnd.randint(0, max(0, len(item) - 14))
            piece = item[start : start + rnd.randint(8, 25)]
            for spot in rnd.sample(range(len(piece)), min(len(piece), rnd.randint(0, 5))):
                piece[spot] = "other"
            text[5:5] = [w.upper() + "," for w in piece]
        rows.append((i, " ".join(text)))
    want = leaks_of(rows, items)
    assert found(d.leaks(docs(rows), docs(items, ITEM))) == want and len(want) > 20


def test_driver_tables(llm, documents):
    sf = "/root/testdata/sf0.001"
    items = duckdb.sql(f"SELECT item_id, text FROM '{sf}/benchmark.parquet'").fetchall()
    got = found(d.leaks(llm.read.parquet(f"{sf}/documents.parquet"), llm.read.parquet(f"{sf}/benchmark.parquet")))
    assert got == leaks_of([r for r in documents if len(r[1]) < 8000], items) | {g for g in got if len(dict(documents)[g[0]]) >= 8000}


def test_short_items_are_found_word_for_word(docs):
    question = "What is the capital of France?"
    items = [(1, question), (2, "yes"), (3, question), (None, "six seven"), (5, "one two three four five six seven")]
    rows = [(1, f"Well: what is the capital of France, then"), (2, "what is the capitol of France"), (3, "Yes!"),
            (None, "five six seven eight"), (None, "one two three four five six seven"), (4, ""), (None, None)]
    assert found(d.leaks(docs(rows), docs(items, ITEM))) == leaks_of(rows, items) == {
        (1, 1), (1, 3), (3, 2), (None, None), (None, 5)}
    kept = d.drop_leaking(docs(rows), docs(items, ITEM)).collect()
    assert sorted(((r.doc_id or 0), r.text) for r in kept if r.text is not None) == [(2, rows[1][1]), (4, "")]


def test_rows_with_null_and_repeated_keys_are_all_found(docs):
    item = " ".join(f"t{k}" for k in range(20))
    rows = [(None, f"a {item} b"), (None, f"c {item}"), (7, item), (7, f"{item} again"), (7, "clean text"), (None, "clean")]
    got = [(r.key, r.item, r.token_at) for r in d.leaks(docs(rows), docs([(1, item), (1, item)], ITEM)).collect()]
    assert sorted(got, key=str) == sorted([(None, 1, 1)] * 4 + [(7, 1, 0)] * 4, key=str)


def test_odd_rows_and_all_columns(docs, odd_rows):
    item = "one two three four five six seven eight nine"
    items = docs([(1, None), (2, ""), (3, item), (3, item), (None, item), (4, "not there")], ITEM)
    assert found(d.leaks(docs(odd_rows), items)) == set()
    df = docs([(1, f"x {item} y", 1), (1, "clean", 2), (None, None, 3)], "doc_id bigint, text string, key int")
    kept = d.drop_leaking(df, items)
    assert kept.columns == df.columns and {r["key"] for r in kept.collect()} == {2, 3}
    assert found(d.leaks(df, docs([], ITEM))) == set() and d.leaks(docs([]), items).collect() == []
