"""Language-model scoring: interpolated modified Kneser-Ney over word pairs.

Pairs of neighbouring words are counted in Spark. The counts are dealt by the
first word's hash and written to the shared folder as sorted hash arrays, one
file per slice of the hash range. Words so frequent that their pairs would
swell one slice are known from the word counts (a quarter as many as there are
slices at most); their pairs are dealt by the hash of the pair. Workers
memory-map the slices and look up whole batches at once, so the model may be
far larger than a worker's memory, and nothing of it passes through the driver
but a few totals and the list of files.

    p(w | v) = max(c(vw) - D, 0) / c(v) + g(v) p(w)
    p(w)     = max(d(w) - D', 0) / T + g' / (V + 1)

c counts pairs, d(w) in how many different pairs w comes second, T is the
number of different pairs, V of different words; D and D' depend on the count
(1, 2, 3 and more) and come from the counts of counts. What the discounts take
away is what g(v) and g' give back, and one unknown word has a share, so the
probabilities add up to one. A text starts after a border mark and ends with
an end token, which is a word like any other.

Words are told apart by 64-bit hashes in the word counts and by their upper 40
bits in the pairs.

Edge cases: NULL text counts as empty (the end token alone). Without training
texts every token has the share of the unknown word, one.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.common import forget_half, stored, whole_text
from granary.session import scratch_path

KNOWN_WORDS = 500_000
FLUSH_TOKENS = 2_000_000  # tokens that a task counts before it passes them on
PAIR_BITS = 40  # of each word's hash in a pair
START, END = 0x5EED << 48, 0xE4D << 48
STEP = np.uint64(0x9E3779B97F4A7C15)


class Words(dict):
    """Hashes of words, worked out once per word."""

    def __missing__(self, word: bytes) -> int:
        self[word] = known = xxhash.xxh64_intdigest(word)
        return known

    def of(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split()
        if len(self) > KNOWN_WORDS:
            forget_half(self)
        out = np.empty(len(words) + 1, dtype=np.uint64)
        out[:-1] = np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))
        out[-1] = END
        return out


def befores(texts: list[np.ndarray]) -> np.ndarray:
    """For each token of the texts the one before it."""
    out = []
    for tokens in texts:
        before = np.empty_like(tokens)
        before[0], before[1:] = START, tokens[:-1]
        out.append(before)
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def short(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - PAIR_BITS)


def pair_keys(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """80 bits of a pair: the first word and 24 bits of the second, then its other 16."""
    return first << np.uint64(24) | second >> np.uint64(16), second & np.uint64(0xFFFF)


def pair_hash(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    mixed = (high ^ low * STEP) * np.uint64(0xFF51AFD7ED558CCD)
    return mixed ^ mixed >> np.uint64(32)


def slice_numbers(first: np.ndarray, keys: np.ndarray, frequent: np.ndarray, slices: int) -> np.ndarray:
    """The slice of each pair, from its first word or, where that is frequent, its key."""
    bits = slices.bit_length() - 1
    spread = among(first, frequent)
    numbers = np.where(spread, keys >> np.uint64(64 - bits), first >> np.uint64(PAIR_BITS - bits))
    return numbers.astype(np.uint16 if slices <= 1 << 16 else np.uint32)  # short numbers are sorted faster


def by_slice(numbers: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each slice's number and the places of its entries, in the order given."""
    if not len(numbers):
        return
    order = np.argsort(numbers, kind="stable")
    numbers = numbers[order]
    starts = np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1]))
    for start, end in zip(starts, [*starts[1:], len(order)]):
        yield int(numbers[start]), order[start:end]


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(known):
        return np.zeros(len(values), dtype=bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def counted(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places of the different keys, in key order, and how often each occurs."""
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, dtype=np.int64)
    if weights is None or not len(keys):
        return order[starts], np.diff(np.append(starts, len(keys)))
    return order[starts], np.add.reduceat(weights[order], starts)


def flushes(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Token hashes of as many texts as a task counts at a time."""
    words, held, size = Words(), [], 0
    for batch in batches:
        for text in batch.column("text").to_pylist():
            held.append(words.of(text))
            size += len(held[-1])
            if size >= FLUSH_TOKENS:
                yield held
                held, size = [], 0
    yield held


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, n`` of all words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in flushes(batches):
            if held:
                words = np.concatenate(held)
                place, n = counted(words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words[place].view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"]
                )

    return texts.mapInArrow(count, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def pair_counts(texts: DataFrame, frequent: np.ndarray, slices: int) -> DataFrame:
    """``slice, high, low, n``: the pairs that each task has counted, as arrays of each slice.

    Arrays cross the network as bytes, one row for a slice and some millions of
    tokens, so neither side handles single pairs outside NumPy.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in flushes(batches):
            if not held:
                continue
            high, low = pair_keys(short(befores(held)), short(np.concatenate(held)))
            keys = pair_hash(high, low)
            place, n = counted(keys)
            high, low, keys = high[place], low[place].astype("<u2"), keys[place]
            numbers, arrays = [], ([], [], [])
            for number, own in by_slice(slice_numbers(high >> np.uint64(24), keys, frequent, slices)):
                numbers.append(number)
                for out, values in zip(arrays, (high, low, n.astype("<i8"))):
                    out.append(values[own].tobytes())
            columns = [pa.array(numbers, pa.int32()), *[pa.array(out, pa.binary()) for out in arrays]]
            yield pa.RecordBatch.from_arrays(columns, names=["slice", "high", "low", "n"])

    return texts.mapInArrow(count, "slice int, high binary, low binary, n binary")


def filesystem(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a Spark path, and the path in it."""
    if uri.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    if "://" not in uri:
        return pyarrow.fs.LocalFileSystem(), uri
    return pyarrow.fs.FileSystem.from_uri(uri)


def write_arrays(folder: str, name: str, arrays: dict[str, np.ndarray]) -> str:
    """Write arrays one after the other into a file of its own name; returns its path."""
    fs, path = filesystem(folder)
    fs.create_dir(path, recursive=True)
    path = f"{path}/{name}-{uuid.uuid4().hex}"
    with fs.open_output_stream(path) as out:
        for array in arrays.values():
            out.write(np.ascontiguousarray(array).tobytes())
    return f"{folder.rstrip('/')}/{path.rsplit('/', 1)[1]}"


@lru_cache(maxsize=1 << 14)
def mapped(uri: str) -> np.memmap:
    """A file as memory-mapped bytes; one of a remote store is copied, mapped and unlinked first."""
    fs, path = filesystem(uri)
    if isinstance(fs, pyarrow.fs.LocalFileSystem):
        return np.memmap(path, dtype=np.uint8, mode="r")
    with tempfile.NamedTemporaryFile() as own, fs.open_input_stream(path) as source:
        while block := source.read(16 << 20):
            own.write(block)
        own.flush()
        return np.memmap(own.name, dtype=np.uint8, mode="r")


def views(uri: str, layout: list[tuple[str, int]]) -> list[np.ndarray]:
    """The arrays of a file, by type and length."""
    raw, at, out = mapped(uri), 0, []
    for kind, n in layout:
        size = np.dtype(kind).itemsize * n
        out.append(raw[at : at + size].view(kind))
        at += size
    return out


# What a slice file holds: pairs seen once, other pairs and their counts, first words and their totals
# (all pairs, and pairs seen once, twice and more often).
SLICE_LAYOUT = ("<u8", "<u8", "<u8", "<u8", "<u8", "<u8", "<u8", "<u8")


def context_totals(first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """First words in order, and their totals: all pairs, pairs seen once, twice, more often."""
    order = np.argsort(first)
    first, n = first[order], n[order]
    starts = np.flatnonzero(np.append(True, first[1:] != first[:-1]))
    kinds = [np.add.reduceat((n == k).astype(np.int64), starts) for k in (1, 2)]
    rest = np.diff(np.append(starts, len(n))) - kinds[0] - kinds[1]
    return first[starts], [np.add.reduceat(n, starts), *kinds, rest]


def write_slices(pairs: DataFrame, folder: str, frequent: np.ndarray, slices: int) -> DataFrame:
    """Write the pair arrays and return what the word level needs, stored.

    Rows of kind 0: ``word``, in how many pairs and how often it comes second.
    Kind 1: a frequent first word and its totals. Kind 2: a slice with its
    file, array lengths and counts of counts.
    """

    def rows(kind: int, word: np.ndarray, numbers: list[np.ndarray], path: str | None = None, notes=None):
        n = len(word)
        columns = [np.asarray(c).astype(np.int64) for c in [*numbers, *[np.zeros(n)] * (4 - len(numbers))]]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, kind, dtype=np.int32)),
                pa.array(np.asarray(word).astype(np.int64)),
                *map(pa.array, columns),
                pa.array([path] * n, pa.string()),
                pa.array([notes] * n, pa.list_(pa.int64())),
            ],
            names=["kind", "word", "a", "b", "c", "d", "path", "notes"],
        )

    def close(number: int, high: np.ndarray, low: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys = pair_hash(high, low)
        place, n = counted(keys, n)
        high, low, keys = high[place], low[place], keys[place]
        first, second = high >> np.uint64(24), (high & np.uint64(0xFFFFFF)) << np.uint64(16) | low
        place, kinds = counted(second)
        yield rows(0, second[place], [kinds])
        spread = among(first, frequent)
        if spread.any():
            yield rows(1, *context_totals(first[spread], n[spread]))
        contexts, totals = context_totals(first, n)
        arrays = [keys[n == 1], keys[n > 1], n[n > 1], contexts, *totals]
        typed = {str(i): a.astype(kind) for i, (a, kind) in enumerate(zip(arrays, SLICE_LAYOUT))}
        path = write_arrays(folder, f"slice-{number}", typed)
        notes = [*[len(a) for a in arrays], *[int((n == k).sum()) for k in (1, 2, 3, 4)]]
        yield rows(2, np.array([number]), [], path, notes)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[bytes, ...]]] = {}
        for batch in batches:
            parts = zip(*(batch.column(c).to_pylist() for c in ("high", "low", "n")))
            for number, part in zip(batch.column("slice").to_pylist(), parts):
                held.setdefault(number, []).append(part)
        for number in list(held):
            high, low, n = (b"".join(c) for c in zip(*held.pop(number)))
            low = np.frombuffer(low, "<u2").astype(np.uint64)
            yield from close(number, np.frombuffer(high, "<u8"), low, np.frombuffer(n, "<i8"))

    written = pairs.repartition("slice").mapInArrow(
        write,
        "kind int, word bigint, a bigint, b bigint, c bigint, d bigint, path string, notes array<bigint>",
    )
    sums = [F.sum(c).alias(c) for c in "abcd"]
    grouped = written.groupBy("kind", "word").agg(*sums, F.max("path").alias("path"), F.max("notes").alias("notes"))
    return stored(grouped, "seconds")


def write_words(words: DataFrame, folder: str, columns: dict[str, str], label: str) -> list[tuple[str, int]]:
    """Write a table of ``word`` and number columns as hash arrays in word order; returns files and lengths."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[b.column(c).to_numpy() for c in ("word", *columns)] for b in batches if b.num_rows]
        if not parts:
            return
        word, *rest = (np.concatenate(c) for c in zip(*parts))
        word = word.view(np.uint64)
        order = np.argsort(word)
        arrays = {"word": word[order]} | {c: r[order].astype(k) for (c, k), r in zip(columns.items(), rest)}
        path = write_arrays(folder, label, arrays)
        yield pa.RecordBatch.from_arrays(
            [pa.array([path]), pa.array([len(word)], pa.int64()), pa.array([int(word[order][0])], pa.uint64()).cast(pa.string())],
            names=["path", "n", "first"],
        )

    flipped = F.col("word").bitwiseXOR(F.lit(-(1 << 63)))  # unsigned order
    dealt = words.select("word", *columns).repartitionByRange(flipped)
    files = stored(dealt.mapInArrow(write, "path string, n bigint, first string"), "files").collect()
    return sorted(((r.path, r.n, int(r["first"])) for r in files), key=lambda r: r[2])


def discounts(n: list[int]) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and more, from how many counts are 1, 2, 3 and 4."""
    out = [0.0]
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    for k in (1, 2, 3):
        d = k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else 0.0
        out.append(d if 0 < d < k else 0.5 * k)
    return np.array(out)


@dataclass
class Model:
    """Totals, discounts and the places of the hash arrays; the arrays stay in their files."""

    tokens: int
    words: int
    pairs: int
    pair_discounts: np.ndarray
    word_discounts: np.ndarray
    word_share: float  # g'
    slice_count: int
    slices: dict[int, tuple[str, list[tuple[str, int]]]]
    frequent: np.ndarray
    frequent_totals: list[np.ndarray]
    word_files: list[tuple[str, int, int]]
    second_files: list[tuple[str, int, int]]

    def search(self, files: list[tuple[str, int, int]], kind: str, keys: np.ndarray) -> np.ndarray:
        """The number beside each key in a set of word files, 0 where it is not there; keys in order."""
        out = np.zeros(len(keys), dtype=np.int64)
        firsts = np.array([f[2] for f in files], dtype=np.uint64)
        bounds = np.append(np.searchsorted(keys, firsts), len(keys))
        for (path, n, _), a, b in zip(files, bounds, bounds[1:]):
            if a < b:
                known, values = views(path, [("<u8", n), (kind, n)])
                out[a:b] = at_keys(known, values, keys[a:b])
        return out

    def logs(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Training count and log10 probability of each token."""
        tokens = np.concatenate(texts)
        word, back = np.unique(tokens, return_inverse=True)
        seen = self.search(self.word_files, "<u8", word)
        second = self.search(self.second_files, "<u8", short(word))
        share = self.word_share / (self.words + 1)
        d = self.word_discounts[np.minimum(second, 3)]
        below = (np.maximum(second - d, 0) / self.pairs + share) if self.pairs else np.full(len(word), share)
        high, low = pair_keys(short(befores(texts)), short(tokens))
        # Each different pair once, in the order of the keys, as the arrays are.
        keys, place, pair = np.unique(pair_hash(high, low), return_index=True, return_inverse=True)
        first, p = high[place] >> np.uint64(24), below[back[place]]
        n, totals = np.zeros(len(p), dtype=np.int64), np.zeros((4, len(p)), dtype=np.int64)
        for number, own in by_slice(slice_numbers(first, keys, self.frequent, self.slice_count)):
            if found := self.slices.get(number):
                once, more, times, contexts, *known = views(*found)
                n[own] = at_keys(more, times, keys[own]) + at_keys(once, None, keys[own])
                gather(totals, own, first[own], contexts, known)
        spread = np.flatnonzero(among(first, self.frequent))
        gather(totals, spread, first[spread], self.frequent, self.frequent_totals)
        own = np.flatnonzero(totals[0])
        d, total = self.pair_discounts, totals[0, own]
        given = (d[1:] @ totals[1:, own]) / total
        p[own] = np.maximum(n[own] - d[np.minimum(n[own], 3)], 0) / total + given * p[own]
        return seen[back], np.log10(p)[pair]


def gather(totals: np.ndarray, rows: np.ndarray, first: np.ndarray, contexts: np.ndarray, known: list) -> None:
    """Set the totals of the rows whose first word is among the contexts."""
    if len(rows) and len(contexts):
        at = np.minimum(np.searchsorted(contexts, first), len(contexts) - 1)
        there = contexts[at] == first
        for total, values in zip(totals, known):
            total[rows[there]] = values[at[there]]


def at_keys(known: np.ndarray, values: np.ndarray | None, keys: np.ndarray) -> np.ndarray:
    """The value beside each key, 0 where it is not there; without values, 1 where it is."""
    if not len(known):
        return np.zeros(len(keys), dtype=np.int64)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, 1 if values is None else values[at], 0).astype(np.int64)


def slice_count(spark: SparkSession) -> int:
    """A power of two, a few times the shuffle partitions, and so in step with the data they are set for."""
    wanted = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return 1 << max(4, (wanted - 1).bit_length())


def train(docs: DataFrame, text: str = "text") -> Model:
    """Count all given texts and write the model's arrays to the shared folder."""
    spark = docs.sparkSession
    folder, slices = scratch_path(spark, "lm"), slice_count(spark)
    texts = docs.select(whole_text(text).alias("text"))
    words = stored(word_counts(texts), "words")
    tokens = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    # At most slices / 4 words have so many tokens.
    large = words.filter(F.col("n") * slices > 4 * tokens[0]).select("word").toPandas()["word"].to_numpy()
    border = np.array([START], dtype=np.uint64)  # comes first in each text
    frequent = np.unique(short(np.append(large.astype(np.int64).view(np.uint64), border)))
    seconds = write_slices(pair_counts(texts, frequent, slices), folder, frequent, slices)
    second = seconds.filter("kind = 0").select("word", F.col("a").alias("kinds"))
    level = second.agg(
        F.coalesce(F.sum("kinds"), F.lit(0)),
        *[F.count_if(F.col("kinds") == k) for k in (1, 2, 3, 4)],
        F.count_if(F.col("kinds") > 2),
    ).first()
    word_discounts = discounts(list(level[1:5]))
    given = word_discounts[1] * level[1] + word_discounts[2] * level[2] + word_discounts[3] * level[5]
    files = seconds.filter("kind = 2").select("word", "path", "notes").collect()
    totals = seconds.filter("kind = 1").select("word", *"abcd").orderBy("word").toPandas()
    return Model(
        tokens=tokens[0],
        words=tokens[1],
        pairs=level[0],
        pair_discounts=discounts([sum(f.notes[8 + k] for f in files) for k in range(4)]),
        word_discounts=word_discounts,
        word_share=given / level[0] if level[0] else 1.0,
        slice_count=slices,
        slices={f.word: (f.path, list(zip(SLICE_LAYOUT, f.notes[:8]))) for f in files},
        frequent=totals["word"].to_numpy().astype(np.uint64),
        frequent_totals=[totals[c].to_numpy() for c in "abcd"],
        word_files=write_words(words, folder, {"n": "<u8"}, "words"),
        second_files=write_words(second, folder, {"kinds": "<u8"}, "seconds"),
    )


def score(docs: DataFrame, model: Model, held_out: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity`` per row."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, own = Words(), shipped.value
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = [words.of(t) for t in batch.column("text").to_pylist()]
            seen, logs = own.logs(texts)
            base = np.log10((seen + 0.5) / (own.tokens + 0.5 * (own.words + 1)))
            sizes = np.array([len(t) for t in texts])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            total = np.add.reduceat(logs, starts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(sizes, pa.int64()),
                    pa.array(np.add.reduceat((seen > 0).astype(np.int64), starts)),
                    pa.array(np.full(len(sizes), own.tokens, dtype=np.int64)),
                    pa.array(np.add.reduceat(base, starts)),
                    pa.array(total),
                    pa.array(10 ** np.minimum(-total / sizes, 300)),
                ],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), held_out.alias("held_out"), whole_text(text).alias("text")
    ).mapInArrow(
        run,
        f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double, perplexity double",
    )
