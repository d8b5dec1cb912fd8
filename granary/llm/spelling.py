"""Spelling variant grouping by blocked Gram matrices.

Two words are near if one inserted, deleted or replaced code point makes them
equal. Their letter counts then differ by a squared distance of one or two, so
words are met in blocks of two adjacent lengths, NumPy products of the letter
counts of a block (Gram matrices) give all squared distances in it, and only
pairs at two or less are compared letter by letter.

Blocks of whole lengths would make every pair of words of a length, so blocks
are finer, and lose no pair. The letters form ``GROUPS`` groups; the key of a
word adds up one number per letter, by its group. A word is in the block of
its own key, and in one block for each group it has a letter of, with the key
of what is left without that letter. Words of equal length that differ by one
letter meet where either has lost it, and a word meets the one that is a
letter longer where that one has lost the letter. The letters in which two
words differ name the one block that counts the pair.

A block of more than ``TILE`` words is cut into tiles, and each pair of tiles
is a block of its own, so no task holds more than two tiles. Pairs stay in the
task: each block returns one row per word, with the number of near words and
the best of them.

Edge cases: NULL texts hold no word, repeated rows count as often as they
occur, and a NULL id reads as empty where runs are misspelled.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import stored, whole_text

LEAST_LETTERS, LEAST_TIMES = 5, 3
RUN = "[a-zÀ-ÿ]"  # after lower-casing A-Z
COMBINED = 300_000  # words that a task adds up before it passes them on
RATIO = 2  # a form is so many times as frequent as its variant
COLUMNS, GROUPS = 32, 16
TILE, TOGETHER = 2048, 256  # words of a tile; of small blocks that share a product
# Letters of European texts from frequent to rare, so that every group has some of both.
FREQUENT = "etaoinshrdlucmfwypvbgkjqxz"
WEIGHTS = np.random.default_rng(12).integers(0, 1 << 63, GROUPS, dtype=np.uint64) | np.uint64(1)
NOT_LOST = -1


def columns_of(letters: np.ndarray) -> np.ndarray:
    """Column of each code point in the letter counts. Rare letters share one, which only shortens distances."""
    plain = np.full(128, -1, dtype=np.int64)
    for rank, letter in enumerate(FREQUENT):
        plain[ord(letter)] = rank
    small = plain[np.minimum(letters, 127)]
    return np.where((letters < 128) & (small >= 0), small, len(FREQUENT) + letters % (COLUMNS - len(FREQUENT)))


def groups_of(letters: np.ndarray) -> np.ndarray:
    return columns_of(letters) % GROUPS


def count_words(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_letters: int = LEAST_LETTERS,
    least_times: int = LEAST_TIMES,
    misspell: int | None = None,
) -> DataFrame:
    """``word, n`` of the lower-cased runs of letters, over whole texts.

    With ``misspell``, one run in so many loses a code point, chosen by a
    checksum of document and run: variants to be found again.
    """
    run = re.compile(f"{RUN}{{{least_letters},}}")  # a run that is shorter cannot become longer

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for key, whole in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = Counter(run.findall(whole.encode().lower().decode()))
                if misspell is None:
                    total.update(own)
                    continue
                start = zlib.crc32(f"{key}:".encode())
                for word, n in own.items():
                    h = zlib.crc32(word.encode(), start)
                    if h % misspell == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                    total[word] += n
            if len(total) > COMBINED:
                yield rows(total)
                total.clear()
        yield rows(total)

    def rows(total: Counter[str]) -> pa.RecordBatch:
        kept = {w: n for w, n in total.items() if len(w) >= least_letters}
        cols = [pa.array(kept.keys(), pa.string()), pa.array(kept.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(cols, names=["word", "n"])

    key = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("key")
    counted = docs.select(key, whole_text(text).alias("text")).mapInArrow(count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_times)


def letters_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words in a row, and the length of each word."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64), np.array(
        [len(w) for w in words], dtype=np.int64
    )


def keyed(words: DataFrame) -> DataFrame:
    """``key, lost, word, n``: the blocks of each word, and the letter group that it has lost there."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters, lengths = letters_of(batch.column("word").to_pylist())
            word_of = np.repeat(np.arange(len(lengths)), lengths)
            group = groups_of(letters)
            own = np.zeros(len(lengths), dtype=np.uint64)
            np.add.at(own, word_of, WEIGHTS[group])
            held = np.unique(word_of * GROUPS + group)
            row, lost = held // GROUPS, held % GROUPS
            rows = pa.array(np.concatenate([np.arange(len(lengths)), row]))
            keys = np.concatenate([own, own[row] - WEIGHTS[lost]]).view(np.int64)
            gone = np.concatenate([np.full(len(lengths), NOT_LOST), lost]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(gone), batch.column("word").take(rows), batch.column("n").take(rows)],
                names=["key", "lost", "word", "n"],
            )

    return words.select("word", "n").mapInArrow(cut, "key bigint, lost int, word string, n bigint")


def tiled(rows: DataFrame, tile: int) -> DataFrame:
    """Add ``tile, a, b``: a block's tiles, and the pairs of tiles that each row is needed in."""
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    large = stored(sizes.filter(F.col("size") > tile), "large-blocks")
    tiles = F.ceil(F.coalesce("size", F.lit(1)) / F.lit(tile)).cast("int")
    placed = rows.join(large, "key", "left").withColumn("tiles", tiles)
    placed = placed.withColumn("tile", F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int"))
    return placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "key",
        F.least("tile", "other").alias("a"),
        F.greatest("tile", "other").alias("b"),
        "tile",
        "lost",
        "word",
        "n",
    )


def near_pairs(words: list[str], block: np.ndarray, tile: np.ndarray, whole: np.ndarray, lost: np.ndarray):
    """Places ``i, j`` of the near pairs of the blocks given, each pair in the one block that counts it.

    ``whole`` marks blocks that are not cut into tiles, or pair a tile with itself.
    """
    letters, lengths = letters_of(words)
    n, width = len(words), int(lengths.max())
    word_of = np.repeat(np.arange(n), lengths)
    exact = np.float32 if width < 1000 else np.float64
    counts = np.bincount(word_of * COLUMNS + columns_of(letters), minlength=n * COLUMNS).reshape(n, COLUMNS).astype(exact)
    squares = (counts * counts).sum(axis=1)
    far = squares[:, None] + squares[None, :] - 2 * (counts @ counts.T)
    i, j = np.nonzero(np.triu(far <= 2, 1))
    same = (block[i] == block[j]) & ((lost[i] >= 0) | (lost[j] >= 0)) & (whole[i] | (tile[i] != tile[j]))
    i, j = i[same], j[same]
    # The longer word first; words of equal length have both lost a letter.
    swap = lengths[i] < lengths[j]
    i, j = np.where(swap, j, i), np.where(swap, i, j)
    more = lengths[i] - lengths[j]
    fit = ((more == 0) & (lost[i] >= 0) & (lost[j] >= 0)) | ((more == 1) & (lost[i] >= 0) & (lost[j] == NOT_LOST))
    i, j, more = i[fit], j[fit], more[fit]
    if not len(i):
        return i, j
    padded = np.zeros((n, width + 1), dtype=np.int64)
    padded[word_of, np.arange(len(letters)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = letters
    long, short = padded[i], padded[j]
    differ = long != short
    at = differ.argmax(axis=1)  # the first letter that differs
    every = np.arange(len(i))
    # Behind it the words must be equal: side by side, or the longer one moved up by a letter.
    behind = np.arange(width)[None, :] >= at[:, None]
    moved = (long[:, 1:] != short[:, :-1]) & behind
    good = differ.any(axis=1) & np.where(more == 0, differ.sum(axis=1) == 1, ~moved.any(axis=1))
    good &= groups_of(long[every, at]) == lost[i]
    good &= (more == 1) | (groups_of(short[every, at]) == lost[j])
    return i[good], j[good]


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """``word, n_near, near, near_n``: number of near words and the most frequent, smallest first in a tie."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size < TOGETHER:
                continue
            part = pa.Table.from_batches(held).combine_chunks()
            starts = starts_of(part)
            if starts[-1] == 0:
                continue  # one block so far
            yield from blocks(part.slice(0, starts[-1]), starts)
            rest = part.slice(int(starts[-1]))
            held, size = rest.to_batches(), rest.num_rows
        if held:
            part = pa.Table.from_batches(held).combine_chunks()
            yield from blocks(part, np.append(starts_of(part), part.num_rows))

    def starts_of(part: pa.Table) -> np.ndarray:
        ids = np.stack([part.column(c).to_numpy() for c in ("key", "a", "b")])
        return np.append(0, np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1)

    def blocks(part: pa.Table, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Small blocks share a product until they have ``TOGETHER`` words."""
        sizes = np.diff(bounds)
        block = np.repeat(np.arange(len(sizes)), sizes)
        several = part.filter(pa.array(sizes[block] > 1))
        block = block[sizes[block] > 1]
        start = 0
        while start < len(block):
            stop = np.searchsorted(block, block[min(start + TOGETHER, len(block)) - 1], side="right")
            yield from one_product(several.slice(start, stop - start), block[start:stop])
            start = stop

    def one_product(part: pa.Table, block: np.ndarray) -> Iterator[pa.RecordBatch]:
        words = part.column("word").to_pylist()
        tile_of, lost, n = (part.column(c).to_numpy() for c in ("tile", "lost", "n"))
        whole = part.column("a").to_numpy() == part.column("b").to_numpy()
        i, j = near_pairs(words, block, tile_of, whole, lost)
        if not len(i):
            return
        of, near = np.concatenate([i, j]), np.concatenate([j, i])
        rank = np.empty(len(words), dtype=np.int64)
        rank[np.lexsort((np.array(words), -n))] = np.arange(len(words))
        order = np.lexsort((rank[near], of))
        of, near = of[order], near[order]
        first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        got, column = pa.array(of[first]), part.column("word").combine_chunks()
        yield pa.RecordBatch.from_arrays(
            [
                column.take(got),
                pa.array(np.diff(np.append(first, len(of)))),
                column.take(pa.array(near[first])),
                pa.array(n[near[first]]),
            ],
            names=["word", "n_near", "near", "near_n"],
        )

    dealt = tiled(stored(keyed(words), "word-blocks"), tile).repartition("key", "a", "b")
    found = dealt.sortWithinPartitions("key", "a", "b").mapInArrow(
        compare, "word string, n_near bigint, near string, near_n bigint"
    )
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n")
    )


def follow(links: DataFrame) -> DataFrame:
    """``word, root``: the end of each chain ``word, form``.

    Every round joins the chains to themselves and so doubles their reach. A
    form is at least ``RATIO`` times as frequent, so there is no circle and the
    rounds are few. Each round is stored.
    """
    chains = stored(links.select("word", F.col("form").alias("root")), "chains")
    while True:
        further = chains.select(F.col("word").alias("root"), F.col("root").alias("next"))
        grown = stored(chains.join(further, "root", "left"), "chains")
        chains = grown.select("word", F.coalesce("next", "root").alias("root"))
        if grown.filter(F.col("next").isNotNull()).isEmpty():
            return chains


def variants(words: DataFrame, ratio: int = RATIO, tile: int = TILE) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of distinct ``word, n``.

    A word's form is its most frequent near word, if that is ``ratio`` times as
    frequent as the word or more; its root is where following the forms ends.
    """
    words = stored(words.select("word", "n"), "words")
    near = near_words(words, tile)
    is_form = F.col("near_n") >= ratio * F.col("n")
    found = words.join(near, "word", "left").select(
        "word",
        F.when(is_form, F.col("near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("near_n")).alias("form_n"),
    )
    found = stored(found, "near-words")
    roots = follow(found.filter(F.col("form").isNotNull()))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
