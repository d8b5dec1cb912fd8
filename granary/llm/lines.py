"""Substring dedup by hashing of sentences, lines and stretches of words.

Texts are cut into sentences at line ends and sentence marks. Sentences are cut
further into pieces, at words whose hash is the smallest of the ``AROUND``
words on either side. Such a border depends on no word farther off, so a
passage has the same borders wherever it is set, and loses a few words at its
edges at most. Units are normalised (lower case, words only) and hashed: each
sentence of ``LEAST_UNIT`` words or more, and each two neighbouring pieces.
Equal digests are grouped globally, and the occurrence of the lowest rank
(document id, then row, then place) is kept. All others are repeats.

A passage is a run of repeated pairs whose kept occurrences follow each other
in one row, so all of its words occur there in the same order; runs of
``least_words`` words or more are removed. What is left of other repeated
sentences and lines is marked as kind ``sentence``. Spans are code point
offsets of the original text and run to the start of the next unit.

Nothing but digests crosses the network. Each text becomes one row of arrays,
each task passes on the digests it has seen with their lowest rank, as arrays
by slice of the hash range, and each slice writes the digests that occur twice
as sorted arrays to the shared folder. Workers memory-map those and look up
the digests of whole batches at once. So a unit that a third of all rows share
is one entry per task, and no group is ever collected.

Edge cases: NULL text counts as empty, text ahead of the first word belongs to
no unit, rows with one id rank by their place in the input, NULL ids come last.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from granary.llm.common import stored, whole_text
from granary.llm.lm import by_slice, slice_count, views, write_arrays
from granary.operators.identity import number_keys
from granary.session import scratch_path

LEAST_WORDS, LEAST_UNIT = 24, 3
AROUND = 3
BREAKS = ".!?\n"
ROW, DOC, RANK = "_row", "_doc", "_rank"
LAST_RANK = (1 << 63) - 1  # of a NULL id
CODES_AT_ONCE = 2_000_000  # code points that are cut together
DIGESTS_AT_ONCE = 2_000_000  # that a task adds up before it passes them on
STEP, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD)
SENTENCE = np.uint64(0x53)  # sets digests of sentences apart from those of pairs
# What a slice file holds: repeated digests in order, and rank, row and place of the kept occurrence.
LAYOUT = ("<u8", "<i8", "<i8", "<i8")


@lru_cache(maxsize=1)
def letters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per code point: whether it belongs to a word, its lower case (one code point), whether it ends a sentence."""
    every = [chr(c) for c in range(0x110000)]
    word = np.array([c.isalnum() or c == "_" for c in every])
    lower = np.array([ord(low) if len(low := c.lower()) == 1 else ord(c) for c in every], dtype=np.uint64)
    ends = np.zeros(len(every), dtype=bool)
    ends[[ord(c) for c in BREAKS]] = True
    return word, lower, ends


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * MIX
    return x ^ x >> np.uint64(29)


def powers(n: int) -> np.ndarray:
    """1, STEP, STEP squared, ... modulo 2 to the 64."""
    return np.cumprod(np.append(np.uint64(1), np.full(max(n - 1, 0), STEP, dtype=np.uint64)), dtype=np.uint64)


def joined(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One hash per stretch of values, in which their order counts."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    sizes = np.diff(np.append(starts, len(values)))
    place = np.arange(len(values)) - np.repeat(starts, sizes)
    return mixed(np.add.reduceat(values * powers(int(sizes.max()))[place], starts) + sizes.astype(np.uint64))


class Cut:
    """The units of several texts, one after the other.

    ``pieces`` per text: first word's offset and words of each piece, and the
    digest of each piece with the next one of its text (0 for the last).
    ``sentences``: first piece, number of pieces, words and digest of each.
    """

    def __init__(self, texts: Sequence[str]) -> None:
        is_word, lower, ends = letters()
        code = np.frombuffer("".join(t + "\n" for t in texts).encode("utf-32-le", "surrogatepass"), "<u4")
        text_at = np.cumsum([0, *[len(t) + 1 for t in texts]])
        inside = is_word[code]
        edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0))
        start, end = edge[::2], edge[1::2]
        at = np.flatnonzero(inside)
        word_at = np.cumsum(end - start) - (end - start)
        word = joined(mixed((lower[code[at]] + np.uint64(1)) * STEP), word_at)
        text = np.searchsorted(text_at, start, side="right") - 1
        breaks = np.cumsum(ends[code])
        new = np.append(True, (breaks[start[1:]] != breaks[end[:-1] - 1]) | (text[1:] != text[:-1]))[: len(start)]
        border = new.copy()
        least = np.ones(len(start), dtype=bool)
        for off in range(1, AROUND + 1):
            apart = text[off:] != text[:-off]
            least[off:] &= apart | (word[off:] < word[:-off])
            least[:-off] &= apart | (word[:-off] <= word[off:])
        border |= least
        piece = np.flatnonzero(border)
        self.words = np.diff(np.append(piece, len(start)))
        self.text = text[piece]
        self.start = start[piece] - text_at[self.text]
        own = joined(word, piece)
        self.pairs = np.zeros(len(piece), dtype=np.uint64)
        self.pairs[:-1] = np.where(self.text[1:] == self.text[:-1], mixed(own[:-1] * STEP + own[1:]), 0)
        sentence = np.flatnonzero(new)
        self.sentence_words = np.diff(np.append(sentence, len(start)))
        self.first_piece = np.searchsorted(piece, sentence)
        self.sentence_pieces = np.diff(np.append(self.first_piece, len(piece)))
        self.sentence_text = self.text[self.first_piece]
        self.sentences = mixed(joined(word, sentence) ^ SENTENCE)
        bounds = np.arange(len(texts) + 1)
        self.piece_bounds = np.searchsorted(self.text, bounds)
        self.sentence_bounds = np.searchsorted(self.sentence_text, bounds)

    def arrays(self, i: int) -> tuple[np.ndarray, ...]:
        """Those of one text: pieces (start, words, pair digest), sentences (first piece, pieces, words, digest)."""
        p, q = self.piece_bounds[i : i + 2]
        s, t = self.sentence_bounds[i : i + 2]
        return (
            self.start[p:q].astype("<u4"),
            self.words[p:q].astype("<u4"),
            self.pairs[p:q],
            (self.first_piece[s:t] - p).astype("<u4"),
            self.sentence_pieces[s:t].astype("<u4"),
            self.sentence_words[s:t].astype("<u4"),
            self.sentences[s:t],
        )


ARRAYS = {"start": "<u4", "words": "<u4", "pair": "<u8", "first": "<u4", "pieces": "<u4", "long": "<u4", "whole": "<u8"}


def text_units(rows: DataFrame) -> DataFrame:
    """``_row, _rank, chars`` and the arrays of each text's units, as bytes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            first, size = 0, 0
            for last, text in enumerate(texts, 1):
                size += len(text)
                if size < CODES_AT_ONCE and last < len(texts):
                    continue
                part, found = batch.slice(first, last - first), Cut(texts[first:last])
                columns = zip(*(map(np.ndarray.tobytes, found.arrays(i)) for i in range(last - first)))
                chars = pa.array([len(t) for t in texts[first:last]], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(ROW), part.column(RANK), chars, *[pa.array(c, pa.binary()) for c in columns]],
                    names=[ROW, RANK, "chars", *ARRAYS],
                )
                first, size = last, 0

    schema = f"{ROW} bigint, {RANK} bigint, chars bigint, " + ", ".join(f"{c} binary" for c in ARRAYS)
    return stored(rows.select(ROW, RANK, "text").mapInArrow(cut, schema), "units")


def unpacked(batch: pa.RecordBatch, name: str) -> list[np.ndarray]:
    return [np.frombuffer(b, ARRAYS[name]) for b in batch.column(name).to_pylist()]


def digests_of(pair: np.ndarray, whole: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A text's digests and their places: pairs first, sentences (of enough words) after them."""
    good = np.flatnonzero(long >= LEAST_UNIT)
    return np.concatenate([pair[:-1], whole[good]]), np.concatenate([np.arange(len(pair[:-1])), len(pair) + good])


def lowest(digest: np.ndarray, rank: np.ndarray, row: np.ndarray, place: np.ndarray, n: np.ndarray):
    """Each digest once, in order, with its lowest occurrence and number of occurrences."""
    order = np.lexsort((place, row, rank, digest))
    digest = digest[order]
    first = np.flatnonzero(np.append(True, digest[1:] != digest[:-1]))[: len(digest)]
    total = np.add.reduceat(n[order], first) if len(first) else n[:0]
    kept = order[first]
    return digest[first], rank[kept], row[kept], place[kept], total


def dealt(units: DataFrame, slices: int) -> DataFrame:
    """``slice`` and the digests that a task has seen, with rank, row, place and number, as arrays of each slice."""
    shift = np.uint64(64 - (slices.bit_length() - 1))

    def passed_on(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        found = lowest(*(np.concatenate(c) for c in zip(*held)))
        numbers = (found[0] >> shift).astype(np.int64)
        places, rows = [], []
        for number, own in by_slice(numbers.astype(np.uint16 if slices <= 1 << 16 else np.uint32)):
            places.append(number)
            rows.append([c[own].tobytes() for c in found])
        return pa.RecordBatch.from_arrays(
            [pa.array(places, pa.int32()), *[pa.array([r[k] for r in rows], pa.binary()) for k in range(5)]],
            names=["slice", "digest", "rank", "row", "place", "n"],
        )

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            of = zip(batch.column(ROW).to_pylist(), batch.column(RANK).to_pylist(), *(unpacked(batch, c) for c in ("pair", "whole", "long")))
            for row, rank, pair, whole, long in of:
                digest, place = digests_of(pair, whole, long)
                k = len(digest)
                held.append((digest, np.full(k, rank), np.full(k, row), place, np.ones(k, dtype=np.int64)))
                size += k
            if size >= DIGESTS_AT_ONCE:
                yield passed_on(held)
                held, size = [], 0
        if held:
            yield passed_on(held)

    return units.select(ROW, RANK, "pair", "whole", "long").mapInArrow(
        deal, "slice int, digest binary, rank binary, row binary, place binary, n binary"
    )


def kept_occurrences(units: DataFrame) -> tuple[int, dict[int, tuple[str, int]]]:
    """Number of slices, and of each slice the file of its repeated digests and how many there are.

    The files stay in the shared folder; the list has one entry per slice.
    """
    spark = units.sparkSession
    slices, folder = slice_count(spark), scratch_path(spark, "repeated")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[bytes, ...]]] = {}
        for batch in batches:
            parts = zip(*(batch.column(c).to_pylist() for c in ("digest", "rank", "row", "place", "n")))
            for number, part in zip(batch.column("slice").to_pylist(), parts):
                held.setdefault(number, []).append(part)
        for number in list(held):
            columns = [np.frombuffer(b"".join(c), k) for c, k in zip(zip(*held.pop(number)), (*LAYOUT, "<i8"))]
            *found, n = lowest(*columns)
            again = n > 1
            if again.any():
                arrays = {str(k): c[again].astype(kind) for k, (c, kind) in enumerate(zip(found, LAYOUT))}
                path = write_arrays(folder, f"slice-{number}", arrays)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int32()), pa.array([path]), pa.array([int(again.sum())], pa.int64())],
                    names=["slice", "path", "n"],
                )

    written = dealt(units, slices).repartition("slice").mapInArrow(write, "slice int, path string, n bigint")
    return slices, {r["slice"]: (r["path"], r["n"]) for r in stored(written, "repeated-digests").collect()}


def look_up(digest: np.ndarray, slices: int, files: dict[int, tuple[str, int]]) -> np.ndarray:
    """Rank, row and place of the kept occurrence of each digest, as columns; row -1 where it occurs once."""
    known, back = np.unique(digest, return_inverse=True)
    out = np.full((3, len(known)), -1, dtype=np.int64)
    shift = np.uint64(64 - (slices.bit_length() - 1))
    for number, own in by_slice((known >> shift).astype(np.uint16 if slices <= 1 << 16 else np.uint32)):
        if number in files:
            path, n = files[number]
            there, *kept = views(path, [(kind, n) for kind in LAYOUT])
            at = np.minimum(np.searchsorted(there, known[own]), n - 1)
            hit = there[at] == known[own]
            for column, values in zip(out, kept):
                column[own[hit]] = values[at[hit]]
    return out[:, back]


def spans_of(row: int, pieces: tuple[np.ndarray, ...], found: np.ndarray, place: np.ndarray, chars: int, least: int):
    """Removed spans of a text: start, end, words, rank of the kept document, and whether it is a passage."""
    start, words, first, count, long = pieces
    n, last = len(start), len(start) - 1
    ends = np.append(start[1:].astype(np.int64), chars)
    sums = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    repeated = (found[1] >= 0) & ((found[1] != row) | (found[2] != place))
    pair = np.flatnonzero(repeated[:last]) if n > 1 else np.zeros(0, dtype=np.int64)
    taken, out = np.zeros(n, dtype=bool), []
    if len(pair):
        kept_row, kept_at = found[1, pair], found[2, pair]
        goes_on = (np.diff(pair) == 1) & (np.diff(kept_row) == 0) & (np.diff(kept_at) == 1)
        runs = np.split(np.arange(len(pair)), np.flatnonzero(~goes_on) + 1)
        done = 0
        for run in runs:
            a, b = max(int(pair[run[0]]), done), int(pair[run[-1]]) + 2  # pieces a .. b - 1
            if sums[b] - sums[a] >= least:
                out.append((int(start[a]), int(ends[b - 1]), int(sums[b] - sums[a]), int(found[0, pair[run[0]]]), True))
                taken[a:b] = True
                done = b
    for k in np.flatnonzero(repeated[max(last, 0) :]):
        s = int(place[max(last, 0) + k]) - n  # number of the sentence
        free = np.flatnonzero(~taken[first[s] : first[s] + count[s]]) + first[s]
        for part in np.split(free, np.flatnonzero(np.diff(free) > 1) + 1) if len(free) else ():
            a, b = int(part[0]), int(part[-1]) + 1
            out.append((int(start[a]), int(ends[b - 1]), int(sums[b] - sums[a]), int(found[0, max(last, 0) + k]), False))
    return out


def repeated_spans(units: DataFrame, least_words: int) -> DataFrame:
    """``_row, _rank, start, end, words, kept, passage`` of all removed spans; ``kept`` is a rank."""
    slices, files = kept_occurrences(units)
    shipped = units.sparkSession.sparkContext.broadcast(files)  # one entry per slice

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {c: unpacked(batch, c) for c in ARRAYS}
            numbers, ranks, chars = (batch.column(c).to_pylist() for c in (ROW, RANK, "chars"))
            of = [digests_of(*(columns[c][i] for c in ("pair", "whole", "long"))) for i in range(len(numbers))]
            bounds = np.cumsum([0, *[len(d) for d, _ in of]])
            if not bounds[-1]:
                continue
            found = look_up(np.concatenate([d for d, _ in of]), slices, shipped.value)
            out = []
            for i, (row, rank, (_, place)) in enumerate(zip(numbers, ranks, of)):
                own = found[:, bounds[i] : bounds[i + 1]]
                if (own[1] >= 0).any():
                    pieces = tuple(columns[c][i] for c in ("start", "words", "first", "pieces", "long"))
                    out += [(row, rank, *s) for s in spans_of(row, pieces, own, place, chars[i], least_words)]
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    names = [ROW, RANK, "start", "end", "words", "kept", "passage"]
    return units.mapInArrow(find, f"{ROW} bigint, {RANK} bigint, start int, end int, words bigint, kept bigint, passage boolean")


def numbered(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(
        F.monotonically_increasing_id().alias(ROW), F.col(f"`{doc_id}`").alias(DOC), whole_text(text).alias("text")
    )


def ranked(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``_row, _rank, text`` of numbered rows, and the ids by rank where a rank is not the id itself."""
    if isinstance(rows.schema[DOC].dataType, IntegralType):
        return rows.withColumn(RANK, F.coalesce(F.col(DOC).cast("bigint"), F.lit(LAST_RANK))).drop(DOC), None
    rows = stored(rows, "numbered")
    ids = number_keys(rows.select(DOC).filter(F.col(DOC).isNotNull()).distinct(), [DOC], RANK, 0)[0]
    ids = stored(ids.select(DOC, F.col(RANK).cast("bigint").alias(RANK)), "ranks")
    known = rows.join(ids, DOC, "left").withColumn(RANK, F.coalesce(RANK, F.lit(LAST_RANK)))
    return known.select(ROW, RANK, "text"), ids


def with_ids(spans: DataFrame, ids: DataFrame | None, kind: str) -> DataFrame:
    """Add ``doc_id`` and ``first_doc_id`` to spans that have ranks."""
    for rank, name in ((RANK, "doc_id"), ("kept", "first_doc_id")):
        if ids is None:
            own = F.when(F.col(rank) != LAST_RANK, F.col(rank)).cast(kind)
            spans = spans.withColumn(name, own)
        else:
            known = ids.select(F.col(RANK).alias("_of"), F.col(DOC).alias(name))
            spans = spans.join(known, F.col(rank) == F.col("_of"), "left").drop("_of")
    return spans


def repeated_text(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS
) -> DataFrame:
    """All repeats: ``doc_id, start, end, n_words, first_doc_id, kind``, no two of which overlap.

    Kind ``passage`` are runs of ``least_words`` words or more that one text
    has had as a whole before; kind ``sentence`` are the other sentences and
    lines of ``LEAST_UNIT`` words or more that occur before, or what passages
    leave of them.
    """
    rows, ids = ranked(numbered(docs, doc_id, text))
    spans = with_ids(repeated_spans(text_units(rows), least_words), ids, docs.schema[doc_id].dataType.simpleString())
    kind = F.when(F.col("passage"), "passage").otherwise("sentence").alias("kind")
    return spans.select("doc_id", "start", "end", F.col("words").alias("n_words"), "first_doc_id", kind)


def repeated_passages(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS
) -> DataFrame:
    """The rows of ``repeated_text`` that are passages: ``doc_id, start, end, n_words, first_doc_id``."""
    return repeated_text(docs, doc_id, text, least_words).filter("kind = 'passage'").drop("kind")


def without_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS, short: bool = True
) -> DataFrame:
    """All rows as ``doc_id, text, removed``: the text that is left, and the removed spans' original offsets.

    Without ``short`` only passages go, and single sentences and lines stay.
    """
    rows = stored(numbered(docs, doc_id, text), "numbered")
    spans = repeated_spans(text_units(ranked(rows)[0]), least_words)
    spans = spans.filter(F.lit(short) | F.col("passage")).groupBy(ROW)
    joined = rows.join(
        stored(spans.agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("removed")), "removed"), ROW, "left"
    )
    joined = joined.withColumn("removed", F.coalesce("removed", F.array().cast("array<struct<start:int,end:int>>")))
    # What is left lies between the end of one span and the start of the next.
    starts = F.concat(F.transform("removed", lambda s: s["start"]), F.array(F.length("text")))
    ends = F.concat(F.array(F.lit(0)), F.transform("removed", lambda s: s["end"]))
    gaps = F.transform(
        F.arrays_zip(ends.alias("e"), starts.alias("s")),
        lambda g: F.substr(F.col("text"), g["e"] + F.lit(1), g["s"] - g["e"]),
    )
    return joined.select(F.col(DOC).alias("doc_id"), F.array_join(gaps, "").alias("text"), "removed")
