"""Benchmark decontamination with spaced seeds.

A seed is a fixed mask over neighbouring tokens: the tokens under its ones are
hashed, the others may be anything. The three masks find every stretch of 13
tokens in which at most three differ (tests/llm holds them to that), whatever
the places of the differences.

The seeds of all test items are hashed once. Training texts are scanned with a
Bloom filter of those hashes, of a fixed size, which lets through little more
than real hits. Hits are joined with the test seeds by hash, and around each
hit the two token sequences are compared along the diagonal: a text leaks an
item if ``WINDOW`` aligned tokens in a row have at most ``SUBSTITUTIONS``
differences. An item of fewer tokens has to be there whole, with the same
share of differences. An item of fewer than eight tokens has one seed, which
covers all of it, and has to be there word for word.

Tokens are words in lower case; punctuation and white space play no part.

Edge cases: NULL texts and items have no tokens and are never found, equal
items are all reported, and an empty benchmark finds nothing. Rows are told
apart by a number of their own, so keys may be NULL or repeat.

A seed that many items and many texts share gives a comparison for each two of
them; the join splits such a seed, but does not leave any of them out.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.common import forget_half, plain_names, stored, whole_text, with_names

MASKS = ("11111", "110101001", "1010011")
WINDOW, SUBSTITUTIONS, LEAST_TOKENS = 13, 3, 8
WHOLE = 100  # a seed of a whole item of n tokens has the number WHOLE + n
FILTER_BITS = 27  # 16 MB, whatever the size of the benchmark
TOKEN = re.compile(r"\w+")
KNOWN_TOKENS = 400_000
STEP = np.uint64(0x9E3779B97F4A7C15)


def allowed(aligned: int) -> int:
    """Differences that a stretch of so many tokens may have; a short item may have none."""
    return 0 if aligned < LEAST_TOKENS else SUBSTITUTIONS * min(aligned, WINDOW) // WINDOW


class TokenHashes:
    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def of(self, text: str) -> np.ndarray:
        tokens = TOKEN.findall(text.lower())
        if len(self.known) > KNOWN_TOKENS:
            forget_half(self.known)
        known = self.known
        for token in set(tokens).difference(known):
            known[token] = xxhash.xxh64_intdigest(token.encode("utf-8", "surrogatepass"))
        return np.fromiter(map(known.__getitem__, tokens), dtype=np.uint64, count=len(tokens))


def seeds_of(tokens: np.ndarray, short: Iterable[int] = (), masks: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of all seeds of a token sequence: those of the masks, and stretches of ``short`` tokens."""
    kinds = [(k + 1, [o for o, one in enumerate(mask) if one == "1"]) for k, mask in enumerate(MASKS)] if masks else []
    places, hashes = [], []
    for number, offsets in [*kinds, *((WHOLE + n, range(n)) for n in short)]:
        n = len(tokens) - offsets[-1]
        if n <= 0:
            continue
        total = np.full(n, number, dtype=np.uint64)
        for offset in offsets:
            total = (total ^ tokens[offset : offset + n]) * STEP
            total ^= total >> np.uint64(31)
        places.append(np.arange(n))
        hashes.append(total)
    if not places:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    return np.concatenate(places), np.concatenate(hashes)


def seeds_of_item(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All seeds of the masks, or the one seed of a short item."""
    is_short = len(tokens) < LEAST_TOKENS
    return seeds_of(tokens, [len(tokens)] if is_short else [], masks=not is_short)


def test_seeds(items: DataFrame, item_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Stored tables of the items' tokens and of their seeds."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = TokenHashes()
        for batch in batches:
            tokens = [hashes.of(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item"), pa.array([t.view(np.int64) for t in tokens], pa.list_(pa.int64()))],
                names=["item", "item_tokens"],
            )

    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, tokens in zip(batch.column("number").to_pylist(), batch.column("item_tokens").to_pylist()):
                places, hashes = seeds_of_item(np.array(tokens, dtype=np.int64).view(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hashes.view(np.int64)),
                        pa.array([number] * len(places), pa.int64()),
                        pa.array(places, pa.int32()),
                    ],
                    names=["seed", "number", "item_at"],
                )

    kind = items.schema[item_id].dataType.simpleString()
    source = items.select(F.col(f"`{item_id}`").alias("item"), whole_text(text).alias("text"))
    tokens = source.mapInArrow(cut, f"item {kind}, item_tokens array<bigint>")
    usable = tokens.filter(F.size("item_tokens") > 0)
    numbered = stored(usable.withColumn("number", F.monotonically_increasing_id()), "items")
    seeds = numbered.select("number", "item_tokens").mapInArrow(seed, "seed bigint, number bigint, item_at int")
    return numbered, stored(seeds, "seeds")


def filter_places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of the Bloom filter that belong to each hash."""
    top = np.uint64(64 - FILTER_BITS)
    return (hashes >> top).astype(np.int64), (hashes * STEP >> top).astype(np.int64)


def seed_filter(seeds: DataFrame) -> np.ndarray:
    """The Bloom filter as bytes. Its words are put together in Spark; 2 to the 21 is their most."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = np.concatenate(filter_places(batch.column("seed").to_numpy().view(np.uint64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array((places >> 6).astype(np.int32)), pa.array(np.int64(1) << (places & 63))],
                names=["word", "bit"],
            )

    words = seeds.mapInArrow(bits, "word int, bit bigint").groupBy("word").agg(F.bit_or("bit").alias("bits"))
    found = words.toPandas()
    out = np.zeros(1 << (FILTER_BITS - 6), dtype="<i8")
    out[found["word"].to_numpy().astype(np.int64)] = found["bits"].to_numpy().astype(np.int64)
    return out.view(np.uint8)


def passes(bloom: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places of the hashes that the filter lets through."""
    one, two = filter_places(hashes)
    first = np.flatnonzero(bloom[one >> 3] >> (one & 7) & 1)
    two = two[first]
    return first[(bloom[two >> 3] >> (two & 7) & 1).astype(bool)]


def short_lengths(items: DataFrame) -> list[int]:
    """Lengths of the short items, ``LEAST_TOKENS`` of them at most."""
    size = F.size("item_tokens")
    return sorted(r[0] for r in items.filter(size < LEAST_TOKENS).select(size).distinct().collect())


def hit_regions(
    spark: SparkSession, docs: DataFrame, bloom: np.ndarray, short: list[int], key: str, text: str
) -> DataFrame:
    """Stretches of tokens around hits: ``row, key, region, tokens, hits`` with places inside the stretch.

    ``row`` numbers the rows of ``docs``. Hits less than two windows apart share a stretch, so whatever lies on a
    leak's diagonal is in one.
    """
    shipped = spark.sparkContext.broadcast(bloom)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = TokenHashes()
        for batch in batches:
            owners, regions, stretches, places, seeds = [], [], [], [], []
            for i, text_of in enumerate(batch.column("text").to_pylist()):
                tokens = hashes.of(text_of)
                at, found = seeds_of(tokens, short)
                hit = passes(shipped.value, found)
                if not len(hit):
                    continue
                hit = hit[np.argsort(at[hit], kind="stable")]
                gaps = np.flatnonzero(np.diff(at[hit]) > 2 * WINDOW) + 1
                for own in np.split(hit, gaps):
                    start = max(0, int(at[own[0]]) - WINDOW)
                    owners.append(i)
                    regions.append(start)
                    stretches.append(tokens[start : int(at[own[-1]]) + 2 * WINDOW].view(np.int64))
                    places.append((at[own] - start).astype(np.int32))
                    seeds.append(found[own].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row").take(pa.array(owners, pa.int64())),
                    batch.column("key").take(pa.array(owners, pa.int64())),
                    pa.array(regions, pa.int32()),
                    pa.array(stretches, pa.list_(pa.int64())),
                    pa.array(places, pa.list_(pa.int32())),
                    pa.array(seeds, pa.list_(pa.int64())),
                ],
                names=["row", "key", "region", "tokens", "places", "seeds"],
            )

    kind = docs.schema[key].dataType.simpleString()
    row = F.monotonically_increasing_id().alias("row")
    source = docs.select(row, F.col(f"`{key}`").alias("key"), whole_text(text).alias("text"))
    schema = f"row bigint, key {kind}, region int, tokens array<bigint>, places array<int>, seeds array<bigint>"
    return stored(source.mapInArrow(scan, schema), "regions")


def compare(tokens: np.ndarray, item: np.ndarray, diagonal: int) -> tuple[int, int, int] | None:
    """First token, length and equal tokens of what leaks along a diagonal, if anything does."""
    first, last = max(0, diagonal), min(len(tokens), diagonal + len(item))
    equal = tokens[first:last] == item[first - diagonal : last - diagonal]
    width = min(WINDOW, len(item))
    if len(equal) < width:
        return None
    sums = np.concatenate([[0], np.cumsum(equal)])
    good = np.flatnonzero(sums[width:] - sums[:-width] >= width - allowed(width))
    if not len(good):
        return None
    start, end = int(good[0]), int(good[-1]) + width
    return first + start, end - start, int(sums[end] - sums[start])


def leaks(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per leaking row and item: ``key, item, token_at, aligned, matched``, of its best diagonal."""
    numbered, seeds = test_seeds(items, item_id, item_text)
    regions = hit_regions(docs.sparkSession, docs, seed_filter(seeds), short_lengths(numbered), key, text)
    hits = regions.select("row", "region", F.explode(F.arrays_zip("places", "seeds")).alias("hit")).select(
        "row", "region", F.col("hit.places").alias("at"), F.col("hit.seeds").alias("seed")
    )
    diagonals = (
        hits.join(seeds, "seed").select("row", "region", "number", (F.col("at") - F.col("item_at")).alias("diagonal"))
    ).distinct()

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for i, (tokens, item, diagonal, region) in enumerate(
                zip(*(batch.column(c).to_pylist() for c in ("tokens", "item_tokens", "diagonal", "region")))
            ):
                leak = compare(np.array(tokens), np.array(item), diagonal)
                if leak:
                    found.append((i, region + leak[0], leak[1], leak[2]))
            table = pd.DataFrame(found, columns=["i", "token_at", "aligned", "matched"], dtype="int64")
            taken = pa.array(table["i"])
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c).take(taken) for c in ("row", "key", "number", "item")],
                    *[pa.array(table[c]) for c in ("token_at", "aligned", "matched")],
                ],
                names=["row", "key", "number", "item", "token_at", "aligned", "matched"],
            )

    pairs = (
        diagonals.join(regions.select("row", "key", "region", "tokens"), ["row", "region"])
        .join(numbered, "number")
        .select("row", "key", "region", "tokens", "number", "item", "item_tokens", "diagonal")
    )
    kinds = docs.schema[key].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    checked = pairs.mapInArrow(
        verify, f"row bigint, key {kinds[0]}, number bigint, item {kinds[1]}, token_at bigint, aligned bigint, matched bigint"
    )
    best = F.max(F.struct("matched", -F.col("aligned"), -F.col("token_at"))).alias("best")
    own = [F.any_value(c).alias(c) for c in ("key", "item")]
    return checked.groupBy("row", "number").agg(best, *own).select(
        "key",
        "item",
        (-F.col("best.col3")).alias("token_at"),
        (-F.col("best.col2")).alias("aligned"),
        F.col("best.matched").alias("matched"),
    )


def drop_leaking(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """The rows that leak no test item, with all their columns."""
    plain, names = plain_names(docs)
    rows = stored(plain.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    found = leaks(rows, items, "_row", names[text], item_id, item_text).select(F.col("key").alias("_row")).distinct()
    return with_names(rows.join(stored(found, "leaking"), "_row", "left_anti"), names)
