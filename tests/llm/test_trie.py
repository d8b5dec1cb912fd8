import hashlib
import random
import zlib

import duckdb

from granary.llm import trie
from granary.llm.queries import LLM_ORACLES, op13_prefix_trie

SF = "/root/testdata/sf0.001"
TURN = "conv_id bigint, turn bigint, role string, text string"


def nodes_of(conversations):
    """By definition, from {id: [(role, text), ...]}."""
    members = {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for prefix, own in members.items():
        below = [p for p in members if p[: len(prefix)] == prefix]
        childless = lambda p: not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in members)
        ends = sorted(c for c in own if len(conversations[c]) == len(prefix))
        out.append((
            min(own), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(own),
            sum(len(p) == len(prefix) + 1 for p in below), sum(map(childless, below)),
            sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out)


def rebuilt(conversations, of=5, most=9):
    out = {}
    for c, turns in conversations.items():
        h = zlib.crc32(str(c).encode()) % most
        out[c] = conversations.get(c - c % of, [])[:h] + turns[h:]
    return out


def found(steps, members):
    rows = [tuple(r) for r in trie.prefix_trie(steps, members).collect()]
    return sorted(rows, key=lambda r: (r[0], r[1]))


def test_equals_all_prefixes(docs, monkeypatch):
    monkeypatch.setattr(trie, "LANE", 2)
    monkeypatch.setattr(trie, "CHUNK", 7)
    rnd = random.Random(3)
    chats = {}
    for c in rnd.sample(range(500), 90):
        chats[c] = [(rnd.choice("ab"), rnd.choice(["", "x", "é!"])) for _ in range(rnd.randint(1, 14))]
        if chats and rnd.random() < 0.6:  # goes on like an earlier one
            other = rnd.choice(list(chats.values()))
            chats[c] = other[: rnd.randint(0, len(other))] + chats[c][: rnd.randint(0, 3)] or chats[c]
    chats[1000] = [("a", str(k % 3)) for k in range(60)]
    chats[1001] = chats[1000][:45]
    chats[1002] = chats[1000][:40] + [("b", "end")]
    rows = [(c, t, *turn) for c, turns in chats.items() for t, turn in enumerate(turns)]
    rnd.shuffle(rows)
    steps = trie.turn_digests(docs(rows, TURN))
    assert found(steps, steps.select("conv").distinct()) == nodes_of(chats)


def test_query_equals_definition_and_sql(llm):
    duckdb.sql(f"CREATE OR REPLACE TEMP VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    chats = {}
    for c, role, text in duckdb.sql("SELECT conv_id, role, text FROM conversations ORDER BY conv_id, turn").fetchall():
        chats.setdefault(c, []).append((role or "", text or ""))
    want = nodes_of(rebuilt(chats))
    key = lambda r: (r[0], r[1])
    assert sorted((tuple(r) for r in op13_prefix_trie(llm, SF).collect()), key=key) == want
    assert sorted(duckdb.sql(LLM_ORACLES["op13_prefix_trie"]).fetchall(), key=key) == want


def test_rebuilding_and_turnless_conversations(docs):
    chats = {c: [("u", f"{c % 3}-{t}") for t in range(1 + c % 4)] for c in range(3, 60) if c % 7}
    rows = [(c, t, *turn) for c, turns in chats.items() for t, turn in enumerate(turns)]
    steps, members = trie.shared_openings(trie.turn_digests(docs(rows, TURN)), 5, 9)
    made = rebuilt(chats)
    assert any(not t for t in made.values())
    assert found(steps, members) == nodes_of(made)


def test_odd_rows(docs):
    rows = [(1, None, None, "a"), (1, 2, "u", None), (1, 3, "u", "x"), (2, 2, "", "a"), (2, 5, "u", ""),
            (None, 1, "u", "left out"), (3, 1, "u", "tie"), (3, 1, "u", "tie"), (4, 1, "u", "word " * 50000)]
    extra = docs(rows, TURN).selectExpr("*", "1 AS pos", "2 AS x", "3 AS depth", "4 AS block")
    steps = trie.turn_digests(extra)
    want = nodes_of({1: [("", "a"), ("u", ""), ("u", "x")], 2: [("", "a"), ("u", "")],
                     3: [("u", "tie"), ("u", "tie")], 4: [("u", "word " * 50000)]})
    assert found(steps, steps.select("conv").distinct()) == want
    none = trie.turn_digests(docs([], TURN))
    assert found(none, none.select("conv")) == []
    turnless = docs([(7,), (9,)], "conv bigint")
    assert found(none, turnless) == nodes_of({7: [], 9: []})
