"""SimHash near-dedup with Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits, each a
word of the binary Golay code (23 bits, 4,096 codewords, every word within
three errors of exactly one). The *near* codewords of a word are those within
four errors: one, or six where the nearest is three errors away. So

- two words one error apart share the nearest codeword of either, which is
  among the near codewords of the other;
- two words two errors apart share the nearest codeword of the word between.

Four errors over three segments leave one of these cases (pigeonhole):

- ``SAME_NEAR``: a segment is equal and the next has two errors at most;
- ``SAME_CLOSE``: a segment is equal and the one before has one error at most;
- ``TWO_CLOSE``: two segments have one error each, and of the third, which
  has two at most, one of three parts is equal.

Each case gives join keys that hold the equal bits and the codeword numbers,
31 to 34 bits, so few fingerprints meet by chance. Every meeting is verified,
and counts only under the first case that holds for it, so links are not
repeated. Only distinct fingerprints are joined; copies never are.

Edge cases: NULL and empty texts have fingerprint zero, rows with the same id
are separate rows, and an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache, partial
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.common import no_join_names, plain_names, stored, whole_text, with_names
from granary.llm.components import components

WORDS, SEED, REACH = 4, 42, 4
ROWS_AT_ONCE = 1 << 16
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and width
PART = 7  # width of a part of a segment; the last part takes the rest
# Fixed by the code: its generator polynomial.
GENERATOR, CHECK_BITS, WORD_BITS = 0xC75, 11, 23
SAME_NEAR, SAME_CLOSE, TWO_CLOSE = 0, 3, 6  # first family number of each case
FAMILY_SHIFT = 58
ROW, DOC, FP = "_row", "_doc", "_fp"


def fingerprint_of(text: str, words: int = WORDS, seed: int = SEED) -> int:
    """Signed 64-bit SimHash over word shingles."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    if len(found) <= words:
        shingles: Iterator[bytes] = iter([b" ".join(found)])
        n = 1
    else:
        shingles = map(b" ".join, zip(*[found[i:] for i in range(words)]))
        n = len(found) - words + 1
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=seed), shingles), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, ROWS_AT_ONCE):
        part = hashes[at : at + ROWS_AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, words: int = WORDS, seed: int = SEED) -> Column:
    def of_batch(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t, words, seed) for t in texts], dtype="int64")

    return F.pandas_udf(of_batch, "bigint")(text)


@lru_cache(maxsize=1)
def golay() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the low and high bits of a word, and per remainder its error patterns.

    The patterns of up to three errors have all 2,048 remainders, each once.
    Those of four errors come five to each remainder of three.
    """

    def remainder(word: int) -> int:
        for bit in range(WORD_BITS - 1, CHECK_BITS - 1, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - CHECK_BITS)
        return word

    low = np.array([remainder(w) for w in range(1 << 12)], dtype=np.int64)
    high = np.array([remainder(w << 12) for w in range(1 << 11)], dtype=np.int64)
    patterns: list[list[int]] = [[] for _ in range(1 << CHECK_BITS)]
    for errors in range(5):
        for bits in combinations(range(WORD_BITS), errors):
            word = sum(1 << b for b in bits)
            patterns[low[word & 0xFFF] ^ high[word >> 12]].append(word)
    width = max(map(len, patterns))
    table = np.array([p + [0] * (width - len(p)) for p in patterns], dtype=np.int64)
    count = np.array([len(p) for p in patterns], dtype=np.int64)
    return low, high, table, count


def near_codewords(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codeword numbers within four errors of each word, the nearest first, and which are real."""
    low, high, table, count = golay()
    rest = low[words & 0xFFF] ^ high[words >> 12]
    numbers = (words[:, None] ^ table[rest]) >> CHECK_BITS
    return numbers, np.arange(table.shape[1]) < count[rest][:, None]


def parts_of(words: np.ndarray, width: int) -> list[np.ndarray]:
    last = width - 2 * PART
    return [words & 127, words >> PART & 127, words >> 2 * PART & (1 << last) - 1]


def keys_of(prints: np.ndarray, left: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Positions in ``prints``, keys, and whether the key holds the nearest codeword."""
    bits = prints.astype(np.uint64)
    words = [(bits >> np.uint64(a) & np.uint64((1 << w) - 1)).astype(np.int64) for a, w in SEGMENTS]
    near = [near_codewords(w) for w in words]
    every = np.arange(len(prints))

    def spread(numbers: np.ndarray, real: np.ndarray, family: int, rest: np.ndarray, shift: int) -> tuple:
        rows, columns = np.nonzero(real)
        keys = (family << FAMILY_SHIFT) | rest[rows] | numbers[rows, columns] << shift
        return rows, keys, columns == 0

    for a in range(3):
        following, before = (a + 1) % 3, (a + 2) % 3
        yield spread(*near[following], SAME_NEAR + a, words[a] << 12, 0)
        numbers, real = near[before]
        if left:  # the nearest codeword here, the near ones on the other side
            yield every, (SAME_CLOSE + a << FAMILY_SHIFT) | words[a] << 12 | numbers[:, 0], every >= 0
        else:
            yield spread(numbers, real, SAME_CLOSE + a, words[a] << 12, 0)
        # Segments a and following are close: near codewords of one, the nearest of the other.
        one, other = (a, following) if left else (following, a)
        shift = {a: 0, following: 12}
        for k, part in enumerate(parts_of(words[before], SEGMENTS[before][1])):
            rest = part << 24 | near[other][0][:, 0] << shift[other]
            yield spread(*near[one], TWO_CLOSE + 3 * a + k, rest, shift[one])


def fuzzy_keys(prints: DataFrame, left: bool) -> DataFrame:
    """Join keys of distinct fingerprints, about 65 to 80 each."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for at in range(0, len(values), 4096):
                own = values[at : at + 4096]
                for rows, keys, nearest in keys_of(own, left):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys), pa.array(own[rows]), pa.array(nearest)], names=["key", "fp", "nearest"]
                    )

    return prints.select(FP).mapInArrow(emit, "key bigint, fp bigint, nearest boolean")


def mask(first: int, width: int) -> Column:
    value = ((1 << width) - 1) << first
    return F.lit(value - (1 << 64) if value >> 63 else value)


def links_of(prints: DataFrame, reach: int = REACH) -> DataFrame:
    """All pairs of distinct fingerprints with ``reach`` (4 at most) differing bits or fewer."""
    if reach > 4:
        raise ValueError("the keys find up to four differing bits")
    one, two = fuzzy_keys(prints, True).alias("l"), fuzzy_keys(prints, False).alias("r")
    differ = F.col("l.fp").bitwiseXOR(F.col("r.fp"))
    errors = [F.bit_count(differ.bitwiseAND(mask(a, w))) for a, w in SEGMENTS]
    family = F.lit(None).cast("long")
    for a in (2, 1, 0):
        following, before = (a + 1) % 3, (a + 2) % 3
        first, width = SEGMENTS[before]
        spans = [(first, PART), (first + PART, PART), (first + 2 * PART, width - 2 * PART)]
        equal = [differ.bitwiseAND(mask(*s)) == 0 for s in spans]
        part = F.when(equal[0], 0).when(equal[1], 1).otherwise(2)
        family = F.when((errors[a] == 1) & (errors[following] == 1), TWO_CLOSE + 3 * a + part).otherwise(family)
    for a in (2, 1, 0):
        case = F.when(errors[(a + 1) % 3] <= 2, SAME_NEAR + a).otherwise(SAME_CLOSE + a)
        family = F.when(errors[a] == 0, case).otherwise(family)
    here = F.shiftright(F.col("l.key"), FAMILY_SHIFT)
    # One error or none in the next segment: the left side's nearest codeword is enough.
    two_errors = F.lit(False)
    for a in range(3):
        two_errors = two_errors | ((here == SAME_NEAR + a) & (errors[(a + 1) % 3] == 2))
    met = (
        (F.col("l.key") == F.col("r.key"))
        & (F.col("l.fp") < F.col("r.fp"))
        & (F.bit_count(differ) <= reach)
        & (family == here)
        & ((here >= SAME_CLOSE) | F.col("l.nearest") | two_errors)
    )
    # The planner takes the keys to be as small as the prints they are made from, and would broadcast them.
    return one.join(two.hint("merge"), met).select(F.col("r.fp").alias("high"), F.col("l.fp").alias("low"))


def near_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    carry: Sequence[str] = (),
    words: int = WORDS,
    reach: int = REACH,
) -> DataFrame:
    """One row per input row: fingerprint, component, and whether it is its component's first.

    Returns ``doc_id, fingerprint, component_id, kept`` and the ``carry``
    columns. The first row has the smallest id; NULL ids rank last.
    """
    no_join_names(docs.select(*[f"`{c}`" for c in carry]), ROW, DOC, FP, "root", "first", "node")
    rows = stored(
        docs.select(
            F.monotonically_increasing_id().alias(ROW),
            F.col(f"`{doc_id}`").alias(DOC),
            fingerprint(whole_text(text), words).alias(FP),
            *[F.col(f"`{c}`") for c in carry],
        ),
        "fingerprints",
    )
    first = F.min(F.struct(F.col(DOC).isNull().alias("none"), DOC, ROW)).alias("first")
    classes = stored(rows.groupBy(FP).agg(first), "classes")
    roots = components(links_of(classes, reach))
    rooted = classes.join(roots, F.col(FP) == F.col("node"), "left").select(
        FP, "first", F.coalesce("root", F.col(FP)).alias("root")
    )
    rooted = stored(rooted, "roots")
    firsts = rooted.groupBy("root").agg(F.min("first").alias("first"))
    found = rooted.drop("first").join(firsts, "root").select(
        FP, F.col(f"first.{DOC}").alias("component_id"), F.col(f"first.{ROW}").alias("_first_row")
    )
    # Stored, so that the join deals both sides anew and can split a print that many rows share.
    return rows.join(stored(found, "found"), FP).select(
        F.col(DOC).alias("doc_id"),
        F.lower(F.lpad(F.hex(FP), 16, "0")).alias("fingerprint"),
        "component_id",
        (F.col(ROW) == F.col("_first_row")).alias("kept"),
        *[F.col(f"`{c}`") for c in carry],
    )


def nearest_rows(rows: DataFrame, text: str = "text", words: int = WORDS, reach: int = REACH) -> DataFrame:
    """Pairs ``high, low`` of ``_row`` numbers that the links tie, one at most from each row.

    Of the rows of a fingerprint the first one stands for all; the others are
    tied to it, and it to the first row of the smallest print linked to its own.
    """
    prints = stored(rows.select(ROW, fingerprint(whole_text(text), words).alias(FP)), "fingerprints")
    classes = stored(prints.groupBy(FP).agg(F.min(ROW).alias("first")), "classes")
    least = stored(links_of(classes, reach).groupBy("high").agg(F.min("low").alias("low")), "least-links")
    one = classes.select(F.col(FP).alias("high"), F.col("first").alias("one"))
    two = classes.select(F.col(FP).alias("low"), F.col("first").alias("two"))
    tied = least.join(one, "high").join(two, "low")
    tied = tied.select(F.greatest("one", "two").alias("high"), F.least("one", "two").alias("low"))
    copies = prints.join(classes, FP).filter(F.col(ROW) != F.col("first"))
    return tied.unionByName(copies.select(F.col(ROW).alias("high"), F.col("first").alias("low")))


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The first row of each component, with all its columns."""
    plain, names = plain_names(docs)
    groups = near_groups(plain, names[doc_id], names[text], carry=list(names.values()))
    return with_names(groups.filter("kept"), names)
