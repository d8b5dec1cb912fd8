import random

import numpy as np

from granary.llm import jaccard


def shingles(text):
    found = (text or "").lower().split()
    return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))}


def first_of_each(rows):
    """Rows that stay, by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if 5 * common >= 4 * (len(sets[i]) + len(sets[j]) - common) and root[i] != root[j]:
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    groups = {}
    for row, r in zip(rows, root):
        groups.setdefault(r, []).append(row)
    return sorted((min(g, key=lambda x: (x[0] is None, x[0] or 0)) for g in groups.values()), key=str)


def near_copies(rnd, n_texts=25):
    """Texts and copies with one to nine of 100 to 200 words exchanged: similarities of 0.6 to 0.98."""
    rows = []
    for k in range(n_texts):
        own = [f"w{rnd.randint(0, 3000)}" for _ in range(rnd.randint(100, 200))]
        rows.append((1000 + 20 * k, " ".join(own)))
        for c in range(1, 8):
            copy = list(own)
            for at in rnd.sample(range(len(own)), rnd.randint(1, 9)):
                copy[at] = f"x{rnd.randint(0, 10**6)}"
            rows.append((1000 + 20 * k + c, " ".join(copy)))
    rnd.shuffle(rows)
    return rows


def test_equals_all_pairs(docs, documents, odd_rows):
    rows = near_copies(random.Random(5)) + documents[:60]
    got = sorted((tuple(r) for r in jaccard.drop_near_copies(docs(rows)).collect()), key=str)
    want = first_of_each(rows)
    assert got == want and len(want) < len(rows) - 50
    assert len(jaccard.drop_near_copies(docs(odd_rows)).collect()) == 4
    assert jaccard.drop_near_copies(docs([])).collect() == []


def test_the_stage_drops_copies_of_similarity_four_fifths(llm, docs):
    import corpus_pipeline

    own = [f"w{k}" for k in range(184)]  # 180 shingles
    four = [f"x{k}" if k in (20, 60, 100, 140) else w for k, w in enumerate(own)]  # 160 of 200
    five = [f"y{k}" if k in (10, 50, 90, 130, 170) else w for k, w in enumerate(own)]  # 155 of 205
    rows = [(1, " ".join(own)), (2, " ".join(four)), (3, " ".join(five))]
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(llm, docs(rows), "").collect()) == [1, 3]


def test_long_parity_never_exceeds_the_difference():
    rnd, close = random.Random(4), 0
    for n in (1, 20, 63, 64, 150, 3000):
        for share in (0.02, 0.1, 0.3, 1):
            own = [rnd.getrandbits(64) for _ in range(n)]
            other = [x for x in own if rnd.random() > share] + [rnd.getrandbits(64) for _ in range(int(n * share))]
            one, two = (np.unique(np.array(x, dtype=np.uint64)) for x in (own, other))
            differ = len(np.setxor1d(one, two))
            found = jaccard.least_different(jaccard.long_parity(one), jaccard.long_parity(two))
            assert found <= differ
            close += 2 * found > differ
    assert close > 12


def test_few_pairs_of_a_group_are_fetched(docs, monkeypatch):
    """Of texts around one base, most are not similar to each other, and parity bits tell."""
    rnd, met, whole_sets = random.Random(6), [], jaccard.whole_sets
    monkeypatch.setattr(jaccard, "whole_sets", lambda rows, pairs: met.append(pairs.count()) or whole_sets(rows, pairs))
    base, rows = [f"w{k}" for k in range(150)], []
    for i in range(80):
        at = set(rnd.sample(range(150), rnd.randint(1, 4)))
        rows.append((i, " ".join(f"x{rnd.randint(0, 10**6)}" if k in at else w for k, w in enumerate(base))))
    got = sorted((tuple(r) for r in jaccard.drop_near_copies(docs(rows)).collect()), key=str)
    assert got == first_of_each(rows) and 10 < len(got) < 70
    assert sum(met) < 80 * 79 // 2 // 8


def test_the_stage_goes_through_simhash(llm, docs, documents, monkeypatch):
    import corpus_pipeline

    from granary.llm import simhash

    met, links_of = [], simhash.links_of
    monkeypatch.setattr(simhash, "links_of", lambda *a: met.append(out := links_of(*a)) or out)
    rows = near_copies(random.Random(9), 6) + documents[:30]
    got = sorted((tuple(r) for r in corpus_pipeline.near_dedup(llm, docs(rows), "").collect()), key=str)
    assert got == first_of_each(rows) and len(met) == 1


def test_frequent_shingles_lose_no_pair(docs, monkeypatch):
    monkeypatch.setattr(jaccard, "SAMPLE", 1)
    rnd = random.Random(8)
    common = " ".join(f"c{k}" for k in range(60))
    rows = [(i, f"{t} {common}") for i, t in near_copies(rnd, 12)]
    got = sorted((tuple(r) for r in jaccard.drop_near_copies(docs(rows)).collect()), key=str)
    assert got == first_of_each(rows)


def around(rnd, base, n_texts, most):
    """Copies of ``base`` with up to ``most`` words exchanged."""
    rows = []
    for i in range(n_texts):
        at = set(rnd.sample(range(len(base)), rnd.randint(0, most)))
        rows.append((i, " ".join(f"x{rnd.randint(0, 10**6)}" if k in at else w for k, w in enumerate(base))))
    return rows


def test_a_large_group_makes_few_pairs(docs, monkeypatch):
    rnd, met, verified = random.Random(11), [], jaccard.verified
    monkeypatch.setattr(jaccard, "verified", lambda pairs, *a: met.append(pairs.count()) or verified(pairs, *a))
    rows = around(rnd, [f"w{k}" for k in range(150)], 1000, 6)
    got = sorted((tuple(r) for r in jaccard.drop_near_copies(docs(rows)).collect()), key=str)
    assert got == first_of_each(rows) and 100 < len(got) < 900
    assert sum(met) < 4 * len(rows)


def test_crowds_lose_no_pair(docs, documents, monkeypatch):
    """Crowds of near copies, of copies of copies, and of texts that share a passage only."""
    for name, value in (("CROWD", 4), ("SAMPLE", 1), ("PICKED", 5)):
        monkeypatch.setattr(jaccard, name, value)
    met, crowd_links = [], jaccard.crowd_links

    def counted(apart):
        links, pairs = crowd_links(apart)
        met.extend((links.count(), pairs.count()))
        return links, pairs

    monkeypatch.setattr(jaccard, "crowd_links", counted)
    rnd, common = random.Random(12), " ".join(f"c{k}" for k in range(40))
    rows = around(rnd, [f"w{k}" for k in range(120)], 60, 6)
    copies = around(rnd, rows[7][1].split(), 20, 3) + around(rnd, rows[9][1].split()[:100], 20, 4)
    rows += [(100 + i, t) for i, (_, t) in enumerate(copies)]
    rows += [(2000 + i, f"{t} {common}") for i, t in near_copies(rnd, 8)]
    rows += [(4000 + i, f"{common} " + " ".join(f"y{rnd.randint(0, 10**6)}" for _ in range(i))) for i in range(30)]
    rows += [(5000 + i, t) for i, t in documents[:60]]
    got = sorted((tuple(r) for r in jaccard.drop_near_copies(docs(rows)).collect()), key=str)
    assert got == first_of_each(rows) and len(met) == 2 and min(met) > 10
