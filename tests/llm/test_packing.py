import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from granary.llm import packing
from granary.llm.common import table
from granary.llm.queries import op11_packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


def plain_best_fit(lengths, window):
    """Rooms of the windows, by looking at all of them for each item."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(window - n)
    return sorted(rooms)


@pytest.mark.parametrize("window", [2, 7, 16, 1000, 1024])
def test_best_fit_equals_a_plain_search(window):
    rnd = random.Random(window)
    for n in (0, 1, 30, 400):
        lengths = [rnd.randint(1, window) for _ in range(n)]
        windows, rooms = packing.best_fit(lengths, window)
        assert sorted(rooms) == plain_best_fit(lengths, window)
        assert sorted(i for w in windows for i in w) == list(range(n))
        assert rooms == [window - sum(lengths[i] for i in w) for w in windows]


@pytest.mark.parametrize("slack", [0, 5, 1023])
def test_rests_lie_in_one_piece_each_id_once(slack):
    rnd = random.Random(slack)
    for n in (0, 1, 2, 300):
        rests = [(1024 * rnd.randint(0, 3), rnd.choice([1, 600, rnd.randint(1, 1023)])) for _ in range(n)]
        made = packing.pack_rests(rests, 1024, slack)
        got = [[] for _ in rests]
        for pieces in made:
            total = sum(x[2] for x in pieces)
            assert 0 < total <= 1024
            assert total >= 1024 - slack or total & (total - 1) == 0
            for i, start, length in pieces:
                got[i] += range(start, start + length)
        assert [sorted(g) for g in got] == [list(range(s, s + k)) for s, k in rests]


def checked(rows, texts, window=1024):
    """Each id in one piece, sequences gapless, ids those of the library."""
    own = Tokenizer.from_file(PATH)
    by_sequence, spans = {}, {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
        spans.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= window
    whole = {i: np.array([*own.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for i, t in texts}
    for (i, n), pieces in spans.items():
        assert n == len(whole[i])
    return by_sequence, spans, whole


def test_query_on_whole_texts(llm, documents):
    rows = op11_packing(llm, SF).collect()
    by_sequence, spans, whole = checked(rows, documents)
    assert len(spans) == len(documents)
    for (i, _), pieces in spans.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at
            assert r.ids_crc32 == zlib.crc32(whole[i][at : at + r.length].tobytes())
            at += r.length
        assert at == len(whole[i])
    sizes = [sum(r.length for r in s) for s in by_sequence.values()]
    assert sum(s < 1024 for s in sizes) <= 10  # one task: at most one power of two each


def test_odd_rows(llm, docs, odd_rows):
    extra = docs(odd_rows).select("*", *[F.lit(1).alias(c) for c in ("start", "ids", "sequence_id")])
    rows = packing.pack(extra, PATH, window=16).collect()
    by_sequence, _, whole = checked(rows, odd_rows, 16)
    assert sum(r.length for r in rows) == sum(len(whole[i]) for i, _ in odd_rows)
    assert sum(r.doc_id == 4 and r.start == 0 for r in rows) == 2  # repeated ids are documents of their own
    assert {(r.length, r.doc_tokens) for r in rows if r.doc_id in (1, 2)} == {(1, 1)}
    assert packing.pack(docs([]), PATH).collect() == []


def test_sequences_are_padded_unless_a_power_of_two(llm):
    pieces = packing.pack(table(llm, SF, "documents"), PATH, slack=200).cache()
    made = {r.sequence_id: r for r in packing.sequences(pieces).collect()}
    for k, r in made.items():
        n = r.n_tokens
        assert len(r.ids) == 4 * (n if n & (n - 1) == 0 else 1024)
    want = {}
    for r in sorted(pieces.collect(), key=lambda r: (r.sequence_id, r.offset)):
        want[r.sequence_id] = want.get(r.sequence_id, b"") + bytes(r.ids)
    assert {k: bytes(r.ids[: 4 * r.n_tokens]) for k, r in made.items()} == want
    assert any(n < 1024 for n in (r.n_tokens for r in made.values()))
    pieces.unpersist()
