import random

import numpy as np
import pytest
import xxhash

from granary.llm import simhash
from granary.llm.components import components


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [words] if len(words) <= 4 else [words[i : i + 4] for i in range(len(words) - 3)]
    hashes = [xxhash.xxh64_intdigest(b" ".join(s), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints):
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    values = np.array(prints, dtype=np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 4):
            a, b = sorted((root(i), root(int(j))))
            parent[b] = a
    return [root(i) for i in range(len(prints))]


def test_fingerprints(documents, odd_rows):
    for _, text in documents + odd_rows:
        assert simhash.fingerprint_of(text or "") & (1 << 64) - 1 == plain_fingerprint(text)


def test_all_links_and_no_others(docs):
    rnd = random.Random(3)
    prints = [rnd.getrandbits(64) for _ in range(400)]
    for p in list(prints):
        for _ in range(3):
            for bit in rnd.sample(range(64), rnd.randint(1, 6)):
                p ^= 1 << bit
            prints.append(p)
    signed = [p - (1 << 64) if p >> 63 else p for p in set(prints)]
    got = {(r.low, r.high) for r in simhash.links_of(docs([(p,) for p in signed], "_fp bigint")).collect()}
    values = np.array(signed).view(np.uint64)
    want = set()
    for i, v in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(values ^ v) <= 4):
            if signed[i] < signed[j]:
                want.add((signed[i], signed[j]))
    assert got == want and len(want) > 500
    with pytest.raises(ValueError):
        simhash.links_of(docs([], "_fp bigint"), reach=5)


def test_a_long_chain_is_one_component(docs):
    chain = [(i + 1, i) for i in range(0, 14)] + [(100, 99)]
    random.Random(1).shuffle(chain)
    got = {r.node: r.root for r in components(docs(chain, "high bigint, low bigint")).collect()}
    assert got == {i: 0 for i in range(15)} | {99: 99, 100: 99}
    assert components(docs([], "high bigint, low bigint")).collect() == []


def test_documents_equal_brute_force(docs, documents):
    got = {r.doc_id: r for r in simhash.near_groups(docs(documents)).collect()}
    prints = [plain_fingerprint(t) for _, t in documents]
    for (i, _), p, root in zip(documents, prints, groups(prints)):
        assert (got[i].fingerprint, got[i].component_id) == (f"{p:016x}", documents[root][0])
        assert got[i].kept == (i == documents[root][0])


def test_odd_rows_and_all_columns(docs, odd_rows):
    got = simhash.near_groups(docs(odd_rows)).collect()
    assert len(got) == len(odd_rows) and sum(r.kept for r in got) == 4
    assert {r.component_id for r in got if r.fingerprint == "0" * 16} == {1}
    assert simhash.near_groups(docs([])).collect() == []
    df = docs([(2, "a b", 1, "x"), (1, "a  b", 2, "y")], "doc_id bigint, text string, _fp int, root string")
    assert [tuple(r) for r in simhash.drop_near_copies(df).collect()] == [(1, "a  b", 2, "y")]


def test_each_row_meets_one_linked_row(docs, documents):
    rows = [(i, t) for i, (_, t) in enumerate(documents + documents[:20])]
    rows += [(1000 + i, f"{t} one more word") for i, (_, t) in enumerate(documents[:50])]
    prints = {i: plain_fingerprint(t) for i, t in rows}
    near = {i: {j for j in prints if j != i and (prints[i] ^ prints[j]).bit_count() <= 4} for i in prints}
    got = [tuple(r) for r in simhash.nearest_rows(docs(rows, "_row bigint, text string")).collect()]
    assert len(got) == len(set(got)) < len(rows)
    assert all(high > low and low in near[high] for high, low in got)
    assert {i for pair in got for i in pair} == {i for i in near if near[i]}
