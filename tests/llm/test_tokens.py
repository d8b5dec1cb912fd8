import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from granary.llm import bpe, common, token_counts

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
BITS = ["'re", "'r", "'s", " ", "  ", "\n", "\t", "a", "the", " world", "1", "23", "é", "漢", "!", "<|endoftext|>", "<|",
        "endof", "\xa0", "\x85", "xxxxx", "don't", "'ll", "\U0001f600", "\x1c", "́", "İ", "²"]


@pytest.fixture(scope="module")
def counter():
    return token_counts.PrefixCounter(BYTES)


@pytest.fixture(scope="module")
def library():
    return {p: Tokenizer.from_file(p) for p in (BYTES, WORDS)}


def test_every_prefix_and_budget(counter, library):
    rnd = random.Random(5)
    for _ in range(400):
        text = "".join(rnd.choices(BITS, k=rnd.randint(0, 12)))
        want = [len(library[BYTES].encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
        assert counter.all_prefixes(text).tolist() == want, text
        for budget in (0, 1, 3, 6):
            assert counter.fitting(text, budget) == (want[-1], max(i for i, n in enumerate(want) if n <= budget)), text


def test_counts_equal_the_library(docs, documents, odd_rows, library):
    rows = documents + [(1000 + i, t) for i, (_, t) in enumerate(odd_rows)]
    got = {r.doc_id: r for r in token_counts.token_counts(docs(rows), BYTES, 512).collect()}
    for i, text in rows:
        n = len(library[BYTES].encode(text or "", add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((text or "").encode()), n, n > 512)


def test_stored_counts_answer_budgets(docs, counter):
    df = docs([(1, "the quick brown fox"), (2, None)]).select(
        "doc_id", token_counts.prefix_counts(F.col("text"), BYTES).alias("counts"))
    got = {r.doc_id: r for r in df.select("*", token_counts.prefix_within(F.col("counts"), F.lit(2)).alias("fit")).collect()}
    assert got[1].counts == counter.all_prefixes("the quick brown fox").tolist()
    assert got[1].fit == counter.fitting("the quick brown fox", 2)[1]
    assert got[2].counts == [0] and got[2].fit == 0


def test_forgetting_changes_nothing(monkeypatch, documents, library):
    monkeypatch.setattr(token_counts, "KNOWN_PIECES", 50)
    own = token_counts.PrefixCounter(BYTES)
    for _, text in documents[:15]:
        assert own.count(text) == len(library[BYTES].encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("least,most", [(1, 8), (16, 64), (256, 8192)])
def test_chunk_joins_are_exact(monkeypatch, library, documents, least, most):
    monkeypatch.setattr(bpe, "LEAST_CHUNK", least)
    monkeypatch.setattr(bpe, "MOST_CHUNK", most)
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 100)
    rnd = random.Random(least)
    texts = ["".join(rnd.choices(BITS, k=rnd.randint(0, 300))) for _ in range(150)]
    texts += ["x" * 9000, "é" * 5000, ""] + [t for _, t in documents[:40]]
    own = bpe.ChunkEncoder(WORDS)
    for text, raw in zip(texts, own.encode_batch(texts)):
        ids = library[WORDS].encode(text, add_special_tokens=False).ids
        assert np.frombuffer(raw, "<i4").tolist() == ids, text
        assert own.decode(ids) == library[WORDS].decode(ids, skip_special_tokens=False)


def test_chunks_are_shared_wherever_a_passage_starts():
    rnd = random.Random(1)
    passage = " ".join("".join(rnd.choices("abcdefgh", k=6)) for _ in range(3000)).encode()
    cut = lambda raw: {raw[a:b] for a, b in zip([0, *bpe.chunk_ends(raw)], bpe.chunk_ends(raw))}
    one, two = cut(b"some words first " + passage), cut(b"others " * 40 + passage)
    assert len(one & two) >= 0.7 * len(one)
    assert b"".join(passage[a:b] for a, b in zip([0, *bpe.chunk_ends(passage)], bpe.chunk_ends(passage))) == passage


def test_round_trip_query(docs, documents, odd_rows, library):
    rows = documents + [(1000 + i, t) for i, (_, t) in enumerate(odd_rows)]
    got = {r.doc_id: r for r in bpe.digests(bpe.encode_decode(docs(rows), WORDS)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for i, text in rows:
        ids = library[WORDS].encode(text or "", add_special_tokens=False).ids
        decoded = library[WORDS].decode(ids, skip_special_tokens=False)
        assert tuple(got[i])[1:] == (len(ids), sha(" ".join(map(str, ids))), sha(decoded))


def test_empty_tables(docs):
    assert bpe.encode_decode(docs([]), WORDS).collect() == []
    assert token_counts.token_counts(docs([]), BYTES, 512).collect() == []


def test_the_next_operator_drops_the_encoder():
    common.keep_only("bpe", bpe.encoder.cache_clear)
    own = bpe.encoder(WORDS)
    common.keep_only("bpe", bpe.encoder.cache_clear)
    assert bpe.encoder(WORDS) is own
    common.keep_only("quality")
    assert bpe.encoder.cache_info().currsize == 0 and not common.KEPT
