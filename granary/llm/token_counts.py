"""Token counts by prefix dynamic programming over byte-level BPE.

Byte-level BPE splits a text into pieces and encodes each alone. Within a
piece, a token sequence is the encoding exactly if each pair of neighbours is
the encoding of the pair's own bytes. So the encoding of a prefix is that of a
shorter prefix plus one token that fits the last token there, and one pass
over the piece finds the last token and the token count of every prefix. The
counts are kept per piece (pieces repeat) and added up along the text, which
answers "how many tokens" and "how much text fits a budget" for any prefix
without encoding again.

Edge cases: NULL text counts as empty and has no token. A special token's
string inside a text is one token, as the tokenizer takes it by default.
"""

from __future__ import annotations

import json
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from itertools import accumulate
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.common import forget_half, whole_text

# Fixed by the tokenizer: how byte-level BPE of this family cuts a text.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
KNOWN_PIECES = 500_000  # pieces, and pairs of tokens, that a worker remembers
PLAIN = 0x250  # below this code point all Unicode versions agree on letters, numbers and spaces
# The White_Space property.
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
NEVER = 1 << 60
LAST = itemgetter(-1)


def plain_pieces() -> str:
    """The tokenizer's pattern for plain text, with classes spelled out for the faster ``re``."""
    kinds = {
        k: "".join(re.escape(chr(c)) for c in range(PLAIN) if unicodedata.category(chr(c))[0] == k) for k in "LN"
    }
    letter, number, space = kinds["L"], kinds["N"], SPACES
    return "|".join(
        [
            *CONTRACTIONS,
            f" ?[{letter}]+",
            f" ?[{number}]+",
            f" ?[^{space}{letter}{number}]+",
            f"[{space}]+(?![^{space}])",
            f"[{space}]+",
        ]
    )


def byte_letters() -> dict[str, int]:
    """The vocabulary spells each byte as one printable letter."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Pieces(dict):
    """Counts of the prefixes of each piece, worked out when first asked for."""

    def __init__(self, work_out: Callable[[str], Sequence[int]]) -> None:
        self.work_out = work_out

    def __missing__(self, piece: str) -> Sequence[int]:
        counts = self.work_out(piece)
        if len(piece) <= 64:
            if len(self) >= KNOWN_PIECES:
                forget_half(self)
            self[piece] = counts = bytes(counts)  # no more tokens than bytes: 4 x 64 at most
        return counts


class PrefixCounter:
    """Token counts of every prefix of a text."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, letters = spec["model"], byte_letters()
        if model["type"] != "BPE" or spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("a byte-level BPE tokenizer without normalisation is needed")
        spell = lambda token: bytes(letters[c] for c in token)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {(spell(a), spell(b)): rank for rank, (a, b) in reversed(list(enumerate(pairs)))}
        special = [t["content"] for t in spec["added_tokens"]]
        self.vocab = {spell(t) for t in model["vocab"] if t not in special}
        self.parents = {a + b: (rank, a, b) for (a, b), rank in sorted(self.ranks.items(), key=lambda x: -x[1])}
        self.longest = max(map(len, self.vocab))
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.plain = re.compile(plain_pieces())
        self.blank = re.compile(f"[{SPACES}]+")
        self.path, self.library = path, None
        self.pieces = Pieces(self.of_piece)
        self.fits: dict[tuple[bytes, bytes], bool] = {}
        self.edges: dict[tuple[bytes, bool], list[tuple[bytes, int, int]]] = {}

    def edge(self, token: bytes, right: bool) -> list[tuple[bytes, int, int]]:
        """What stands at one edge of a token while it is merged: part, rank that made it, rank that used it."""
        known = self.edges.get((token, right))
        if known is None:
            known, used, part = [], NEVER, token
            while part:
                rank, a, b = self.parents.get(part, (-1, b"", b""))
                known.append((part, rank, used))
                used, part = rank, b if right else a
            known = self.edges[token, right] = known[::-1]
        return known

    def neighbours(self, a: bytes, b: bytes) -> bool:
        """Whether two tokens stay apart: no merge across their border comes up in time.

        Parts at the two edges meet while both exist. They merge if their rank
        comes before the rank that uses up the left part, and not after the one
        that uses up the right part, for equal ranks are merged from the left.
        """
        known = self.fits.get((a, b))
        if known is not None:
            return known
        left, right, i, j, known = self.edge(a, True), self.edge(b, False), 0, 0, True
        while i < len(left) and j < len(right):
            x, _, x_used = left[i]
            y, _, y_used = right[j]
            rank = self.ranks.get((x, y), NEVER)
            if rank < x_used and rank <= y_used and rank < NEVER:
                known = False
                break
            if x_used == y_used == NEVER:
                break
            if x_used <= y_used:
                i += 1
            else:
                j += 1
        if len(self.fits) >= KNOWN_PIECES:
            forget_half(self.fits)
        self.fits[a, b] = known
        return known

    def prefixes(self, piece: bytes) -> list[int]:
        """Token counts of the prefixes of 0, 1, ... bytes of a piece.

        Exactly one last token fits each prefix, so the likely ones are tried
        first: the one that extends the token before, then shorter ones.
        """
        last, starts, counts = [b""], [0], [0]
        vocab, fits, neighbours = self.vocab, self.fits.get, self.neighbours
        for end in range(1, len(piece) + 1):
            grown = starts[-1]
            for start in (*range(grown, end), *range(max(0, end - self.longest), grown)):
                token = piece[start:end]
                if token in vocab and (
                    start == 0
                    or (fits((last[start], token)) or neighbours(last[start], token))
                ):
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")
            last.append(token)
            starts.append(start)
            counts.append(counts[start] + 1)
        return counts

    def of_piece(self, piece: str) -> Sequence[int]:
        """Counts of the prefixes of 1, 2, ... code points of a piece."""
        raw = piece.encode()
        counts = self.prefixes(raw)
        if len(raw) == len(piece):
            return counts[1:]
        return [counts[e] for e in accumulate(len(c.encode()) for c in piece)]

    def split(self, text: str) -> list[str]:
        """Pieces of a text without special tokens."""
        if text.isascii() or max(text) < chr(PLAIN):
            return self.plain.findall(text)
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path).pre_tokenizer
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def segments(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text between special tokens, and these (True)."""
        at = 0
        for m in self.special.finditer(text) if self.special else ():
            if m.start() > at:
                yield text[at : m.start()], False
            yield m[0], True
            at = m.end()
        if at < len(text):
            yield text[at:], False

    def totals(self, text: str) -> tuple[list[str], list[int]]:
        """Pieces, and the tokens of each."""
        pieces: list[str] = []
        counts: list[int] = []
        for segment, special in self.segments(text):
            found = [segment] if special else self.split(segment)
            pieces += found
            counts += [1] if special else map(LAST, map(self.pieces.__getitem__, found))
        return pieces, counts

    def count(self, text: str) -> int:
        return sum(self.totals(text)[1])

    def all_prefixes(self, text: str) -> np.ndarray:
        """Token counts of the prefixes of 0, 1, ... all code points."""
        pieces, counts = self.totals(text)
        out = np.zeros(len(text) + 1, dtype=np.int64)
        at = before = 0
        for i, piece in enumerate(pieces):
            out[at + 1 : at + 1 + len(piece)] = self.inside(pieces, i, before)
            at += len(piece)
            before += counts[i]
        return out

    def inside(self, pieces: list[str], i: int, before: int) -> list[int]:
        """Counts of the prefixes that end inside or at the end of piece ``i``.

        A prefix is cut as a text of its own, which differs from the whole
        text's pieces in three places: a special token's string is ordinary
        text until it is complete, the last of several white space characters
        leaves its run only when something follows it, and a contraction is
        two pieces until it is complete.
        """
        piece = pieces[i]
        if self.special and self.special.fullmatch(piece):
            back = i  # to the start of the last white space, where any text can be cut
            while back and not self.special.fullmatch(pieces[back - 1]):
                back -= 1
                if self.blank.fullmatch(pieces[back]) and not (back and self.blank.fullmatch(pieces[back - 1])):
                    break
                if pieces[back][0] == " " and not (back and self.blank.fullmatch(pieces[back - 1])):
                    break
            ground = "".join(pieces[back:i])
            base = before - self.count(ground)
            return [base + self.count(ground + piece[:k]) for k in range(1, len(piece))] + [before + 1]
        counts = [before + c for c in self.pieces[piece]]
        if piece in CONTRACTIONS and len(piece) == 3:
            counts[1] = before + 2
        if i and self.blank.match(piece) and self.blank.fullmatch(pieces[i - 1]):
            run = pieces[i - 1]
            counts[0] = before - self.pieces[run][-1] + self.pieces[run + piece[0]][-1]
        return counts

    def fitting(self, text: str, budget: int) -> tuple[int, int]:
        """Tokens of the text, and the code points of its longest prefix within ``budget`` tokens."""
        pieces, counts = self.totals(text)
        total = sum(counts)
        if total <= budget:
            return total, len(text)
        ends = [0, *accumulate(counts)]
        i = bisect_right(ends, budget) - 1  # the first piece that ends beyond the budget
        at = best = sum(map(len, pieces[:i]))
        # A prefix that ends further on may still fit, as its last pieces may join.
        while i < len(pieces) and ends[max(0, i - 4)] <= budget:
            for k, c in enumerate(self.inside(pieces, i, ends[i]), 1):
                if c <= budget:
                    best = at + k
            at += len(pieces[i])
            i += 1
        return total, best


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def token_counts(
    docs: DataFrame, path: str, budget: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit, fit_chars`` per row.

    ``fit_chars`` is the length in code points of the longest prefix that stays
    within ``budget`` tokens.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            answers = [own.fitting(t, budget) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array([n for n, _ in answers], pa.int64()),
                    pa.array([n > budget for n, _ in answers], pa.bool_()),
                    pa.array([c for _, c in answers], pa.int64()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), whole_text(text).alias("text")).mapInArrow(
        count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean, fit_chars bigint"
    )


def prefix_counts(text: Column, path: str) -> Column:
    """Token counts of the prefixes of 0, 1, ... code points, as an array to store with the text."""

    def counts(texts: pd.Series) -> pd.Series:
        own = counter(path)
        return texts.map(lambda t: own.all_prefixes(t or ""))

    return F.pandas_udf(counts, "array<bigint>")(text)


def prefix_within(counts: Column, budget: Column) -> Column:
    """Length of the longest prefix within a budget, from stored counts alone."""
    fits = F.transform(counts, lambda c, i: F.when(c <= budget, i))
    return F.array_max(fits)
